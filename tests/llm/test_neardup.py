"""Near-duplicates against brute force over all pairs."""

import random
import re
import subprocess
import sys

import numpy as np
import pytest

from medalyst.llm import neardup, shingles
from tests.llm.conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    found = WORD.findall((text or "").translate(LOWER))
    return {tuple(found[i:i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} if found else set()


def brute(rows):
    """(doc_id, n_shingles, component) per row."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1:]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted((str(i), len(s), str(find(i)) if i is not None else "None") for i, s in sets)


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["component_id"] in (None, r["doc_id"])) for r in rows)
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows)


def edited(rng, line, share):
    return [w if rng.random() > share else f"new{rng.randint(0, 10**6)}" for w in line]


def test_chains_families_and_shared_passages(make_docs):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows, number = [], 100
    for family in range(12):
        line = [rng.choice(vocabulary) for _ in range(rng.randint(30, 200))]
        for _ in range(15):
            rows.append((number, " ".join(line)))
            line = edited(rng, line, 0.012)                 # each a step away from the one before
            number += rng.randint(1, 3)
    for _ in range(60):                                     # different texts around one passage
        rows.append((number, " ".join([*(rng.choice(vocabulary) for _ in range(rng.randint(5, 60))), *passage])))
        number += 1
    rng.shuffle(rows)
    docs = make_docs([(i, t, "en", "a") for i, t in rows])
    assert found(neardup.near_duplicates(docs)) == brute(rows)


def test_blocks_of_a_large_key(make_docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0.005, 0.02, 0.04])))) for i in range(50)]
    docs = make_docs([(i, t, "en", "a") for i, t in rows])
    assert found(neardup.near_duplicates(docs)) == brute(rows)


def test_odd_rows(odd_docs, odd_rows):
    assert found(neardup.near_duplicates(odd_docs)) == brute([(i, t) for i, t, *_ in odd_rows])


def test_rows_of_one_id_are_one_document(make_docs):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    rows = [(3, a), (4, b), (9, a), (9, b), (5, " ".join(f"c{i}" for i in range(20)))]
    got = found(neardup.near_duplicates(make_docs([(i, t, "en", "a") for i, t in rows])))
    assert got == brute(rows) and {c for i, _, c in got if i in "349"} == {"3"}


def test_near_copies_of_any_text_of_an_id(make_docs):
    rng = random.Random(21)
    rows = []
    for i in range(12):                                    # several texts under one id, a near copy of one of them under another
        texts = [[f"t{i}_{k}_{j}" for j in range(80)] for k in range(3)]
        rows += [(10 * i + 7, " ".join(t)) for t in texts for _ in range(2)]
        rows.append((10 * i + 9, " ".join([*texts[i % 3][:-1], "changed"])))
    rng.shuffle(rows)
    got = found(neardup.near_duplicates(make_docs([(i, t, "en", "a") for i, t in rows])))
    assert got == sorted((str(i), len(shingle_set(t)), str(i // 10 * 10 + 7)) for i, t in rows)


def test_empty_table(no_docs):
    assert neardup.near_duplicates(no_docs).collect() == []
    assert neardup.one_of_each(no_docs).collect() == []


def test_one_of_each_keeps_columns_and_unnamed_rows(odd_docs, odd_rows):
    kept = neardup.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect())
    wanted = {i for i, _, c in brute([(i, t) for i, t, *_ in odd_rows]) if i == c and i != "None"}
    assert ids == sorted([*wanted, "None", "None"])


def test_lower_similarity_is_refused(odd_docs):
    with pytest.raises(ValueError):
        neardup.near_duplicates(odd_docs, numerator=50)


def test_word_hashes_follow_words():
    texts = [b"Ab cd", b"", b"ab\x0bCD \xc3\xa9", b"ab cd"]
    hashes, owner = shingles.word_hashes(texts)
    assert owner.tolist() == [0, 0, 2, 2, 2, 3, 3]
    assert hashes[0] == hashes[2] == hashes[5] and hashes[1] == hashes[3] == hashes[6] and len(np.unique(hashes)) == 3


def test_word_hashes_across_stretches_and_steps(monkeypatch):
    texts = [words(1, 400).encode(), b"x" * 9001 + b" " + b"x" * 9000, b"", b"y" * 9001, words(2, 300).encode()]
    plain = [sum(int(shingles._BYTE[c]) * pow(shingles._BASE, i, 2**64) for i, c in enumerate(w)) % 2**64 for text in texts for w in text.split()]
    for stretch in (16, 1000, 1 << 20):
        monkeypatch.setattr(shingles, "_STRETCH", stretch)
        hashes, owner = shingles.word_hashes(texts)
        assert hashes.tolist() == shingles.mixed(np.array(plain, np.uint64)).tolist()
        assert np.bincount(owner, minlength=5).tolist() == [400, 2, 0, 1, 300]


def test_a_long_text_leaves_no_memory_behind():
    code = ("import resource, gc\nfrom medalyst.llm import shingles\n"
            "rss = lambda: int(open('/proc/self/statm').read().split()[1]) * resource.getpagesize() >> 20\n"
            "shingles.shingle_sets(['a b c d e f'])\nbefore = rss()\ntext = 'some words of a text ' * (32 * 2**20 // 21)\n"
            "shingles.shingle_sets([text])\ndel text\ngc.collect()\nassert rss() - before < 50, rss() - before")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
