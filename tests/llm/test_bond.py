"""Hard negatives: brute force over random and odd vectors, bounds that never lose a row, odd tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from medalyst.llm import bond
from medalyst.session import durable

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, lane int, block binary, score double"


def brute(rows, relabel=True, n_positives=5, n_negatives=10):
    whole = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        held = [min(max(256 * float(np.float32(x)), -bond.PEAK), bond.PEAK) for x in vector]
        whole.append((i, [math.floor(x) for x in held], (label + 1) % 10 if relabel and i % 7 == 0 else label))
    out = []
    for i, query, label in whole:
        if i % 100:
            continue
        scored = [(j, l, sum(a * b for a, b in zip(query, v))) for j, v, l in whole]
        near = sorted((-s, j) for j, l, s in scored if l == label and j != i)[:n_positives]
        for s, j in near:
            hard = sorted((-t, k) for k, l, t in scored if l != label and 30 * -s <= 100 * t <= 90 * -s)[:n_negatives]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1, b"y", 0.5) for r in rows], SCHEMA)
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in bond.mine(table, F.col("id") % 100 == 0, label).collect())


def vectors(seed, n, width, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, width))
    return [(i, (spread * rng.normal(0, 0.4, width) + centres[rng.integers(5)]).tolist(), int(rng.integers(4))) for i in range(n)]


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(bond, "ROW_BYTES", 4 * 8 * 37)


def test_equals_brute_force(spark, small_blocks):
    rows = vectors(1, 420, 8)
    found = mined(spark, rows)
    assert found == brute(rows) and len(found) > 100


def test_ties_copies_and_odd_rows(spark, small_blocks):
    rows = vectors(2, 250, 3)
    one = rows[100][1]
    rows += [(300 + i, one, i % 3) for i in range(60)]                                   # equal vectors: ties everywhere
    rows += [(None, one, 1), (500, None, 1), (600, one, None), (700, [1.0, None, 2.0], 1), (800, [1.0, math.nan, 1.0], 1),
             (900, [math.inf, 0.0, 0.0], 2), (1000, [], 1), (1100, one[:2], 2), (1200, [0.0, 0.0, 0.0], 2), (1300, [1e30, -1e30, 3.0], 1),
             (301, one, 1), (301, one, 1)]
    assert mined(spark, rows) == brute(rows)


def test_bounds_never_lose_a_row():
    rng = np.random.default_rng(5)
    for _ in range(60):
        values = rng.integers(-50, 50, (rng.integers(1, 30), rng.integers(1, 200))).astype(np.float64)
        query = rng.integers(-9, 9, len(values)).astype(np.float64)
        exact = query @ values
        alive = rng.random(values.shape[1]) < 0.7
        k = int(rng.integers(1, 6))
        at, scores = bond.scan(values, query, alive.copy(), bond.nearest(k))
        assert np.array_equal(scores, exact[at])
        assert set(np.flatnonzero(alive)[np.argsort(-exact[alive], kind="stable")[:k]]) <= set(at)
        windows = [(-40, 60), (10, 300), (5, 4)]
        at, scores = bond.scan(values, query, alive.copy(), bond.in_windows(windows, k))
        assert np.array_equal(scores, exact[at])
        for least, most in windows:
            inside = np.flatnonzero(alive & (exact >= least) & (exact <= most))
            assert set(inside[np.argsort(-exact[inside], kind="stable")[:k]]) <= set(at)


def test_bounds_are_exact_up_to_the_last_bit():
    """At the edge of what 24 bits hold, in windows that end at a score, and where no column is read or no row given."""
    rng = np.random.default_rng(8)
    for kind, most in ((np.float32, 1800), (np.float64, 30_000_000), (np.int64, 1 << 24)):
        values = rng.integers(-most, most, (5, 300)).astype(kind)
        query = rng.integers(-most, most, 5).astype(kind)
        exact = np.array([sum(int(a) * int(b) for a, b in zip(query, column)) for column in values.T], object)
        ends = sorted(exact)
        windows = [(ends[40], ends[90]), (ends[80], ends[81]), (ends[200], ends[290]), (ends[9], ends[8])]
        at, scores = bond.scan(values, query, np.ones(300, bool), bond.in_windows(windows, 4), bond.bounds(values))
        assert [int(s) for s in scores] == [exact[i] for i in at]
        for least, most_here in windows:
            inside = sorted((-int(s), i) for i, s in enumerate(exact) if least <= s <= most_here)
            assert {i for _, i in inside[:4]} <= set(at.tolist())
        at, scores = bond.scan(values, 0 * query, np.ones(300, bool), bond.nearest(300))
        assert len(at) == 300 and not scores.any()
        assert not len(bond.scan(values[:, :0], query, np.ones(0, bool), bond.in_windows(windows, 4))[0])


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-60_000, 60_000) for _ in range(40)], i % 2) for i in range(0, 260)]
    assert mined(spark, rows) == brute(rows)


def test_copies_for_the_lanes_are_not_gathered_on_the_driver(spark, small_blocks):
    table = spark.createDataFrame([(*r, "x", 1, b"y", 0.5) for r in vectors(4, 420, 8)], SCHEMA)
    rows = bond.scaled(table, "vec_id", "embedding", "label", 256)
    blocks, anchors = durable(bond.packed(rows)), durable(bond.packed(rows.where("id % 100 = 0"), bond.ANCHORS))
    near = bond.positives(blocks, anchors, 5)
    hard = bond.negatives(blocks, anchors, durable(near), 10, 30, 90)
    for found in (near, hard):
        assert found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "Broadcast" not in plan


def test_few_and_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0, 2.0], 1)]) == []
    assert mined(spark, [(100, [1.0, 2.0], 1), (101, [1.0, 2.0], 1), (102, [0.5, 1.0], 2)]) == [(100, 101, 1, 102, 5 * 256**2, 5 * 256**2 // 2)]
