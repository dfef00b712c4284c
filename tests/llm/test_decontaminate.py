"""Benchmark leaks against a plain Smith-Waterman over every document and item."""

import random
import re

import numpy as np
import pytest

from medalyst.llm import decontaminate

WORD = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")


def plain_score(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        here = [0]
        for j, y in enumerate(b, 1):
            here.append(max(0, above[j - 1] + (2 if x == y else -1), above[j] - 1, here[j - 1] - 1))
        best, above = max(best, *here), here
    return best


def split(text):
    return [w.lower() for w in WORD.findall(text or "")]


@pytest.fixture(scope="module")
def tables(spark, make_docs):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 60
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(12, 40)))) for i in range(12)] + [(50, "of the"), (51, None), (52, "")]
    rows = []
    for i in range(80):
        line = [rng.choice(vocabulary) for _ in range(rng.randint(10, 150))]
        if i % 3 == 0:
            copy = [w if rng.random() > 0.12 else f"x{rng.randint(0, 9)}" for w in items[i % 12][1].split()]
            if rng.random() < 0.5:
                del copy[len(copy) // 2]
            at = rng.randint(0, len(line))
            line[at:at] = copy
        rows.append((i, ", ".join(line), "en", "a"))
    return make_docs(rows), rows, spark.createDataFrame(items, "item_id bigint, text string"), items


def wanted(rows, items, least):
    return {(i, k) for i, t, *_ in rows for k, item in items if len(split(item)) >= 3
            and plain_score(split(item), split(t)) >= 2 * least * len(split(item))}


def test_like_plain_alignment(tables):
    docs, rows, tests, items = tables
    found = decontaminate.leaks(docs, tests).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == wanted(rows, items, 0.5)
    for r in found:
        text, item = next(t for i, t, *_ in rows if i == r["doc_id"]), dict(items)[r["item_id"]]
        assert abs(r["similarity"] - plain_score(split(item), split(text)) / (2 * len(split(item)))) < 1e-9
        assert plain_score(split(item), split(text)[r["first_word"]:r["last_word"]]) > 0


def test_partial_copies_of_long_items(spark, make_docs):
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 300
    line = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(line(400))) for i in range(4)]
    rows = []
    for i in range(60):
        copied = [0, 8, 20, 60, 190][i % 5]
        at = rng.randint(0, 400 - copied)
        rows.append((i, " ".join([*line(rng.randint(5, 80)), *items[i % 4][1].split()[at:at + copied], *line(rng.randint(5, 80))]), "en", "a"))
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    held = {(i, k) for i, t, *_ in rows for k, item in items if plain_score(split(item), split(t)) >= 26}
    assert {(i, i % 4) for i in range(60) if i % 5 > 1} <= held and {i for i, _ in held} == {i for i in range(60) if i % 5 > 1}
    docs = make_docs(rows)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, tests).collect()} == held
    assert {r["doc_id"] for r in decontaminate.clean(docs, tests).collect()} == {i for i in range(60) if i % 5 <= 1}


def test_parts_of_a_large_benchmark(tables, monkeypatch):
    docs, rows, tests, items = tables
    monkeypatch.setattr(decontaminate, "WORDS_AT_ONCE", 100)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, tests).collect()} == wanted(rows, items, 0.5)


def test_clean_keeps_the_others(tables):
    docs, rows, tests, items = tables
    kept = decontaminate.clean(docs, tests)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted({i for i, *_ in rows} - {i for i, _ in wanted(rows, items, 0.5)})


def test_common_words_only(spark, make_docs):
    common = "the of and the of and the and of"
    docs = make_docs([(1, f"x y z {common} q", "en", "a"), (2, "the of and", "en", "a")] + [(i, "the of and " * 50, "en", "a") for i in range(3, 9)])
    found = decontaminate.leaks(docs, spark.createDataFrame([(1, common)], "item_id bigint, text string"), expected=1e-6).collect()
    assert 1 in {r["doc_id"] for r in found}


def test_scripts_without_spaces(spark, make_docs):
    rng = random.Random(8)
    signs = {"zh": [chr(0x4E00 + i) for i in range(600)], "ja": [chr(0x3041 + i) for i in range(80)], "th": [chr(0x0E01 + i) for i in range(46)]}
    line = lambda lang, n: "".join(rng.choice(signs[lang]) for _ in range(n))
    items = [(i, line(lang, 60)) for i, lang in enumerate(signs)]
    items += [(3, "\u3002".join(line("zh", 8) for _ in range(10))), (4, "\u201cl\u2019eau\u201d \u2014 source\u2026vive d\u2019azur\u00a0pur")]
    rows = []
    for k, lang in enumerate(signs):
        rows += [(10 * k, items[k][1], lang, "a"), (10 * k + 1, line(lang, 300), lang, "a"),
                 (10 * k + 2, line(lang, 100) + items[k][1][:40] + line(lang, 3) + items[k][1][43:] + line(lang, 100), lang, "a")]
    rows += [(30, items[3][1].replace("\u3002", "\uff0c"), "zh", "a"), (31, "x l'eau, source vive d'azur pur y", "fr", "a")]
    found = decontaminate.leaks(make_docs(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 0), (2, 0), (10, 1), (12, 1), (20, 2), (22, 2), (30, 3), (31, 4)}
    assert all(r["similarity"] > 0.85 for r in found)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    text = odd_rows[0][1]
    tests = spark.createDataFrame([(1, text), (1, text), (None, " ".join(text.split()[5:30]))], "item_id bigint, text string")
    found = decontaminate.leaks(odd_docs, tests).collect()
    assert {r["doc_id"] for r in found} == {5, 6, 7, None} and all(r["similarity"] > 0.9 for r in found)
    assert decontaminate.leaks(no_docs, tests).collect() == []
    none = spark.createDataFrame([], tests.schema)
    assert decontaminate.leaks(odd_docs, none).collect() == [] and decontaminate.clean(odd_docs, none).count() == len(odd_rows)


def test_lookup():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64))
    lookup = decontaminate.Lookup(keys)
    at, place = lookup(np.concatenate([keys[::7], keys[::7] + np.uint64(1)]))
    assert at.tolist() == list(range(len(keys[::7]))) and (keys[place] == keys[::7]).all()
    assert len(decontaminate.Lookup(np.empty(0, np.uint64))(keys)[0]) == 0
