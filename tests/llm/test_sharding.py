"""Sharding: groups stay together, loads are near equal, slots have no gap."""

import random
import zlib
from collections import Counter, defaultdict

from medalyst.llm import sharding


def test_heap_order_is_longest_first():
    items = [(7, "a"), (7, "b"), (6, "c"), (5, "d"), (4, "e")]
    assert sharding.longest_first(items, 2) == {"a": 0, "b": 1, "c": 0, "d": 1, "e": 1}
    assert sharding.longest_first([], 3) == {}


def check(rows, found, shards=16):
    assert Counter((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows) == \
        Counter((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in found)
    by_text, slots, loads = defaultdict(set), defaultdict(list), Counter()
    for r in found:
        by_text[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


def test_balance_and_groups(make_docs):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcdef") for _ in range(int(rng.paretovariate(1.2) * 20))), "en", "a") for i in range(1500)]
    rows += [(5000 + i, rows[3][1], "en", "a") for i in range(40)]
    loads = check(rows, sharding.shard(make_docs(rows)).collect())
    largest = max(len(t) + 1 for _, t, *_ in rows)
    assert len(loads) == 16 and max(loads.values()) <= max(sum(loads.values()) / 16 * 1.02, largest)


def test_one_group_of_a_third(make_docs):
    rows = [(i, "same text " * 5, "en", "a") for i in range(300)] + [(1000 + i, f"text {i} " * 7, "en", "a") for i in range(600)]
    loads = check(rows, sharding.shard(make_docs(rows)).collect())
    rest = sorted(loads.values())[:-1]
    assert max(rest) <= 1.05 * min(rest)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check(odd_rows, sharding.shard(odd_docs).collect())
    assert sharding.shard(no_docs).collect() == []
