"""Edit fingerprints: order of documents, edited texts, and likeness."""

import hashlib
import random

import numpy as np
import pytest

from medalyst.llm import edit_fingerprint
from tests.llm.conftest import words


def likeness_of(a, b):
    prints = edit_fingerprint.fingerprints([a, b])
    return float(edit_fingerprint.likeness(prints[:1], prints[1:], np.array([not a]), np.array([not b]))[0])


def plain_walk(text, walk):
    """What one walk writes at each step, character by character."""
    out = {}
    for number in range(-(-len(text) // edit_fingerprint.SEGMENT)):
        segment = text[number * edit_fingerprint.SEGMENT:(number + 1) * edit_fingerprint.SEGMENT]
        at = 0
        for step in range(edit_fingerprint.STEPS):
            if at == len(segment):
                break
            seen = (ord(segment[at]) * 2654435761 % 2**32 >> 24) or 1
            out[number * edit_fingerprint.STEPS + step] = seen
            at += int(edit_fingerprint._MOVES[step][seen]) >> walk & 1
    return out


def plain_print(text):
    walks = [plain_walk(text, walk) for walk in range(edit_fingerprint.WALKS)]
    longest, level = max(max(w) for w in walks) + 1, 0
    while longest > edit_fingerprint.SLOTS << level:
        level += 1
    out = [level]
    for walk, written in enumerate(walks):
        for slot in range(edit_fingerprint.SLOTS):
            at = int(edit_fingerprint.places(level)[walk, slot])
            total = 0
            for i in range(edit_fingerprint.TRAIL):
                before = at - edit_fingerprint.TRAIL + 1 + i
                same = before // edit_fingerprint.STEPS == at // edit_fingerprint.STEPS
                total += (written.get(before, 0) if same else 0) * int(edit_fingerprint._WEIGHTS[i])
            total %= 2**32
            total = (total ^ total >> 15) * 2246822519 % 2**32
            out.append(1 + (total >> 16) % 255 if at in written else 0)
    return [*out, 0]


def test_fingerprints_are_those_of_plain_walks():
    rng = random.Random(3)
    texts = ["a", "ab", "é漢🎉", " ", words(1, 3), words(2, 9), words(3, 80), "a" * 4000, words(4, 2000), words(5, 30_000), ""]
    texts += ["".join(rng.choice("ab 漢") for _ in range(rng.randrange(1, 300))) for _ in range(60)]
    texts += [words(6, 3000)[:n] for n in (edit_fingerprint.SEGMENT - 1, edit_fingerprint.SEGMENT, edit_fingerprint.SEGMENT + 1)]
    got = edit_fingerprint.fingerprints(texts)
    for row, text in zip(got, texts, strict=True):
        assert row.tolist() == (plain_print(text) if text else [0] * len(row))


def test_finer_levels_hold_the_coarser():
    for level in range(1, 12):
        fine, coarse = edit_fingerprint.places(level - 1), edit_fingerprint.places(level)
        assert (np.diff(coarse, axis=1) > 0).all() and (coarse >> level == np.arange(edit_fingerprint.SLOTS)).all()
        assert all(set(coarse[w, :edit_fingerprint.SLOTS // 2]) <= set(fine[w]) for w in range(edit_fingerprint.WALKS))
    # two lengths on either side of a level agree where their walks do
    text = words(9, 400)
    prints = edit_fingerprint.fingerprints([text[:n] for n in range(20, len(text), 20)])
    assert len(set(prints[:, 0].tolist())) > 3 and (edit_fingerprint.agreement(prints[1:], prints[:-1]) > 0.4).all()
    assert (edit_fingerprint.agreement(prints[40:], prints[39:-1]) > 0.85).all()


def mean_likeness(texts, others):
    return sum(map(likeness_of, texts, others)) / len(texts)


@pytest.mark.parametrize("n", [3, 8, 20, 60, 300, 2000])
def test_likeness_at_every_length(n):
    rng = random.Random(n)
    texts = [words(i, n) for i in range(100 if n < 1000 else 10)]
    others = [words(10**6 + i, n) for i in range(len(texts))]
    holes = [rng.randrange(len(t)) for t in texts]
    assert mean_likeness(texts, [t[:k] + t[k + 1:] for t, k in zip(texts, holes, strict=True)]) > (0.9 if n > 3 else 0.8)
    assert 0.6 < mean_likeness(texts, [t[:len(t) - len(t) // 3] + o[:len(t) // 3] for t, o in zip(texts, others, strict=True)]) < 0.8
    assert mean_likeness(texts, others) < 0.1


def test_likeness_follows_edits():
    rng = random.Random(7)
    text = words(1, 800)
    scores = []
    for share in (0.0, 0.002, 0.01, 0.05, 0.3):
        edited = "".join(rng.choice(["", "z", c + "y"]) if rng.random() < share else c for c in text)
        scores.append(likeness_of(text, edited))
    assert scores[0] == 1 and scores == sorted(scores, reverse=True) and scores[1] > 0.7 and scores[-1] < 0.3
    assert likeness_of("", "") == 1 and likeness_of("", text) == 0
    # an edit distance counts the order
    assert likeness_of(text, text[len(text) // 2:] + text[:len(text) // 2]) < 0.2


def test_bands_find_like_texts():
    rng, found, wanted = random.Random(11), 0, 0
    for i in range(300):
        text = words(i, rng.choice((5, 12, 40, 120, 400)))
        share = rng.choice((0.002, 0.01, 0.02, 0.1))
        edited = "".join(rng.choice(["", "z", c + "y"]) if rng.random() < share else c for c in text)
        edited = edited[:len(edited) - rng.randrange(len(edited) // 5 + 1)]
        prints = edit_fingerprint.fingerprints([text, edited])
        if 0.75 <= likeness_of(text, edited) < 0.9:
            a, b = edit_fingerprint.band_keys(prints)
            wanted += 1
            found += bool(set(a) & set(b))
    assert wanted > 50 and found >= 0.95 * wanted


def wanted(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or ""))
    out = []
    for i, row in enumerate(order):
        text, following = row[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        out.append((str(row[0]), len(text), hashlib.sha256(edited.encode()).hexdigest(), round(likeness_of(text, edited), 9), round(likeness_of(text, following), 9)))
    return sorted(out)


def found(df):
    return sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in df.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 200])
def test_next_documents(make_docs, n):
    rows = [(i * 7 % 1009, words(i, i % 40 + 1), "en", "a") for i in range(n)]
    assert found(edit_fingerprint.edited_copies(make_docs(rows))) == wanted(rows)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    assert found(edit_fingerprint.edited_copies(odd_docs)) == wanted(odd_rows)
    assert edit_fingerprint.edited_copies(no_docs).collect() == []


def test_equal_texts_have_equal_fingerprints(odd_docs):
    rows = edit_fingerprint.fingerprinted(odd_docs, out="print").select("text", "print").collect()
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text"] or "", set()).add(r["print"])
    assert all(len(v) == 1 for v in by_text.values()) and by_text[""] == {""}


def test_near_pairs(make_docs, odd_docs, no_docs):
    texts = {i: words(i, 300) for i in (1, 2, 3)}
    texts |= {10: texts[1], 11: texts[1][:900] + "x" + texts[1][900:], 12: "", 13: None}
    found = {(r["a"], r["b"]): r["likeness"] for r in edit_fingerprint.near_pairs(make_docs([(i, t, "en", "a") for i, t in texts.items()])).collect()}
    assert found[1, 10] == 1 and abs(found[1, 11] - likeness_of(texts[1], texts[11])) < 1e-9
    assert set(found) <= {(1, 10), (1, 11), (10, 11)}
    assert {(r["a"], r["b"]) for r in edit_fingerprint.near_pairs(odd_docs).collect()} >= {(14, 15)}
    assert edit_fingerprint.near_pairs(no_docs).collect() == []


def test_groups_keep_links_beside_the_smallest_id(make_docs, no_docs):
    # the middle text is like both others, which are not like each other; the smallest id shares bands with all
    parts = [words(i, 150) for i in range(40, 46)]
    base = " ".join(parts)
    rows = [(1, base)]
    front = len(" ".join(parts[:2]))
    rows += [(i, words(900 + i, 400)[:front] + base[front:]) for i in range(2, 6)]         # a third of base gone, the rest in its place
    rows += [(10 + i, row[1] + f" tail{i}") for i, row in enumerate(rows[1:])]
    rows += [(30, ""), (31, None), (None, base), (32, base)]
    texts = {i: t or "" for i, t in rows if i is not None}
    prints = {i: edit_fingerprint.fingerprints([t])[0] for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    keys = {i: set(edit_fingerprint.band_keys(row[None])[0]) for i, row in prints.items()}

    def banded(a, b):
        return bool(keys[a] & keys[b])

    near = {(a, b) for a in texts for b in texts if a < b and texts[a] and texts[b] and banded(a, b) and likeness_of(texts[a], texts[b]) >= 0.75}
    assert any((1, a) not in near and (1, b) not in near and banded(1, a) for a, b in near)
    for a, b in sorted(near):
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    docs = make_docs([(i, t, "en", "a") for i, t in rows])
    got = edit_fingerprint.near_groups(edit_fingerprint.fingerprinted(docs, out="fingerprint")).select("doc_id", "component_id", "n_links").collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(i, find(i)) for i in texts} | {(None, None)} and len(got) == len(rows)
    assert all((r["n_links"] > 0) == any(r["doc_id"] in pair and (prints[pair[0]] != prints[pair[1]]).any() for pair in near)
               for r in got if r["doc_id"] is not None)
    joined = {i: i for i in texts}
    for r in edit_fingerprint.near_pairs(docs).collect():
        one, two = joined[r["a"]], joined[r["b"]]
        joined = {i: min(one, two) if c in (one, two) else c for i, c in joined.items()}
    assert joined == {i: find(i) for i in texts}
    assert edit_fingerprint.near_groups(edit_fingerprint.fingerprinted(no_docs, out="fingerprint")).collect() == []
