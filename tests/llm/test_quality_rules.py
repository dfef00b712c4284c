"""Repetition rules: suffix order and maximal repeats against enumeration, base counts, verdicts, odd tables."""

import random
import re

import numpy as np

from medalyst.llm import quality_rules as rules
from medalyst.llm.suffixes import Suffixes, word_numbers
from tests.llm.conftest import words

WORD = re.compile("[^\x20\x09-\x0d]+")


def random_texts(rng):
    texts = []
    for _ in range(rng.randint(1, 5)):
        kinds = rng.choice([1, 2, 4, 30])
        text = [b"%d" % rng.randrange(kinds) for _ in range(rng.randint(0, 60))]
        if text and rng.random() < 0.6:
            at = rng.randrange(len(text))
            text += text[at:at + rng.randint(1, 30)]
        texts.append(text)
    return texts


def test_suffix_order_and_shared_words():
    rng = random.Random(2)
    for _ in range(150):
        texts = random_texts(rng)
        ids, counts = word_numbers(texts)
        owner = np.repeat(np.arange(len(texts)), counts)
        suffixes = Suffixes(ids, owner)
        ends = np.cumsum(counts)
        suffix = lambda i: ids[i:ends[owner[i]]].tolist()  # noqa: E731, B023
        assert suffixes.order.tolist() == sorted(range(len(ids)), key=lambda i: (owner[i], suffix(i)))
        for a, b in [(rng.randrange(len(ids)), rng.randrange(len(ids))) for _ in range(30 * (len(ids) > 1))]:
            if a != b:
                same = 0
                while owner[a] == owner[b] and same < min(len(suffix(a)), len(suffix(b))) and suffix(a)[same] == suffix(b)[same]:
                    same += 1
                back = 0
                while min(a, b) - back > 0 and owner[a - back - 1] == owner[b - back - 1] == owner[a] == owner[b] and ids[a - back - 1] == ids[b - back - 1]:
                    back += 1
                assert suffixes.shared_ahead(np.array([a]), np.array([b]))[0] == same
                if owner[a] == owner[b]:
                    assert suffixes.shared_behind(np.array([a]), np.array([b]))[0] == back


def brute(text, least):
    """Words in repeated 3-word windows; words under maximal repeats; the longest of them; how many spans."""
    n = len(text)
    windows, spans, longest, starts = set(), set(), 0, 0
    depth = [max((next((k for k in range(n) if max(i, j) + k >= n or text[i + k] != text[j + k]), 0) for j in range(n) if j != i), default=0) for i in range(n)]
    for i, d in enumerate(depth):
        windows |= set(range(i, i + 3)) if d >= 3 else set()
        if d >= least and not (i and depth[i - 1] == d + 1):
            spans |= set(range(i, i + d))
            longest, starts = max(longest, d), starts + 1
    return len(windows), len(spans), longest, starts


def test_repeats_equal_enumeration():
    rng = random.Random(4)
    for _ in range(120):
        texts = random_texts(rng)
        least = rng.randint(3, 12)
        found = rules.repeats(*word_numbers(texts), least)
        assert [tuple(int(c[i]) for c in found) for i in range(len(texts))] == [brute(text, least) for text in texts]


def test_base_counts_and_verdicts(spark, make_docs):
    plain = words(5, 400)
    passage = words(6, 45)
    rows = [(1, plain, "en", "a"), (2, words(7, 49), "en", "a"), (3, " ".join([passage] * 5), "en", "a"),
            (4, f"{words(8, 600)} {passage} {words(9, 500)} {passage}", "en", "a"),              # one long repeat
            (5, " ".join(f"{words(20 + i, 20)} {words(10, 12)}" for i in range(8)), "en", "a"),  # many short ones
            (6, f"{words(8, 600)} {words(10, 12)} {words(9, 500)} {words(10, 12)}", "en", "a"),
            (7, "a # b\n\n \t\na # b\na # b \nc é漢 $$\x0b|&\nc", "en", "a")]
    found = {r["doc_id"]: r for r in rules.judged(make_docs(rows)).collect()}
    assert [i for i in sorted(found) if found[i]["kept"]] == [1, 6]
    assert [i for i in sorted(found) if found[i]["base_failed"]] == [2, 3, 7]
    assert found[4]["longest_repeat"] == 45 and found[4]["n_covered"] == 90 and found[6]["n_covered"] == 24
    last = found[7]
    assert (last["n_words"], last["word_chars"], last["n_symbols"], last["n_dup_lines"]) == (14, 17, 7, 1)
    for i, text, *_ in rows:
        split = WORD.findall(text)
        assert (found[i]["n_words"], found[i]["word_chars"]) == (len(split), sum(map(len, split)))


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    found = rules.judged(odd_docs).collect()
    assert len(found) == len(odd_rows) and all(r["n_words"] is not None and r["kept"] is not None for r in found)
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in odd_rows)
    by_id = {r["doc_id"]: r for r in found}
    assert (by_id[9]["n_words"], by_id[10]["base_failed"], by_id[14]["n_words"], by_id[14]["kept"]) == (0, True, 30_000, True)
    assert rules.judged(no_docs).collect() == []
