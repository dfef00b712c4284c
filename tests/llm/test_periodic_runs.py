"""Periodic runs: brute force over random and periodic texts, the wavelet tree, odd tables and a long text."""

import hashlib
import random
import time
import zlib

import numpy as np

from medalyst.llm import periodic_runs as runs


def brute(words, least=runs.LEAST, times=runs.TIMES):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_text(rng):
    out, kinds, size = [], rng.choice([1, 2, 3, 5, 50]), rng.randint(0, 250)
    while len(out) < size:
        if rng.random() < 0.5:
            base = [rng.randrange(kinds) for _ in range(rng.randint(1, rng.choice([3, 10, 40])))]
            if rng.random() < 0.4:
                base = ([rng.randrange(kinds) for _ in range(rng.randint(1, 4))] * 20)[:rng.randint(1, 30)] + base
            out += (base * 6)[:len(base) * rng.randint(1, 5) + rng.randint(0, len(base))]
        else:
            out += [rng.randrange(kinds) for _ in range(rng.randint(1, 20))]
    return [b"%d" % x for x in out]


def test_equals_brute_force():
    rng = random.Random(7)
    total = 0
    for _ in range(400):
        texts = [periodic_text(rng) for _ in range(rng.randint(1, 4))]
        wanted = [brute(text) for text in texts]
        assert [[tuple(r) for r in found.tolist()] for found in runs.runs_of(texts)] == wanted
        total += sum(map(len, wanted))
    assert total > 500


def test_words_of_a_fibonacci_text():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 1500:
        a, b = b, b + a
    assert [tuple(r) for r in runs.runs_of([b])[0].tolist()] == brute(b)


def test_wavelet_tree():
    rng = np.random.default_rng(1)
    values = rng.permutation(200)
    tree = runs.WaveletTree(values)
    low, high, bound = rng.integers(0, 200, 500), rng.integers(0, 201, 500), rng.integers(0, 300, 500)
    high = np.maximum(low, high)
    for a, b, v, found in zip(low, high, bound, tree.successor(low, high, bound), strict=True):
        wanted = values[a:b][values[a:b] >= v]
        assert found == wanted.min() if len(wanted) else found > 300


def expected(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and words and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_report_of_odd_rows(spark, make_docs, no_docs, odd_rows):
    rng = random.Random(11)
    rows = [r for r in odd_rows if len(r[1] or "") < 10_000]
    rows += [(100 + i, " \n".join(w.decode() for w in periodic_text(rng)) + " x y\x1c", "en", "a") for i in range(60)]
    rows += [(200, "a " * 60, "en", "a"), (201, "a b c " * 9 + "a b", None, None), (-5, "x y " * 40, "en", "a")]
    found = runs.report(make_docs(rows), runs.repeated_tail)
    assert sorted(map(tuple, found.collect()), key=str) == sorted((expected(i, t) for i, t, *_ in rows), key=str)
    assert sum(r["n_runs"] > 0 for r in found.collect()) > 20
    assert runs.report(no_docs).collect() == []


def test_long_texts():
    rng = random.Random(3)
    passage = [b"%d" % rng.randrange(50) for _ in range(3000)]
    mixed = [b"%d" % rng.randrange(10**6) for _ in range(200_000)] + passage * 5 + [b"end"] + [b"a", b"b"] * 100_000
    start = time.perf_counter()
    found = runs.runs_of([mixed])[0].tolist()
    assert [200_000, 15_000, 3000] in found and [215_001, 200_000, 2] in found and time.perf_counter() - start < 60
