"""Skew-proof ordered operators against plain windows and brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from medalyst.operators import ordered, quantiles
from medalyst.operators.reshape import month_grid, step_grid
from medalyst.plans.contest import season_boundaries
from medalyst.plans.registrations import box_stats


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; another has a single one; some keys are NULL."""
    rng = random.Random(7)
    keys = ["hot"] * 300 + ["warm"] * 20 + ["lone"] + [None] * 15
    data = [(k, i, float(rng.randint(0, 9))) for i, k in enumerate(keys)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, id int, v double").cache()


def test_row_numbers_match_window(skewed, rows):
    w = Window.partitionBy("k").orderBy("v", "id")
    want = rows(skewed.withColumn("row_no", F.row_number().over(w)), "id", "row_no")
    assert rows(ordered.number_rows(skewed, ["v", "id"], ["k"]), "id", "row_no") == want


def test_global_row_numbers_are_gapless(skewed):
    got = sorted(r[0] for r in ordered.number_rows(skewed, ["v", "id"], slices=6).select("row_no").collect())
    assert got == list(range(1, skewed.count() + 1))


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_lags_cross_slices(skewed, rows, slices):
    w = Window.partitionBy("k").orderBy("id")
    want = rows(skewed.withColumns({"a": F.lag("v", 1, -1.0).over(w), "b": F.lag("v", 3, -1.0).over(w)}), "id", "a", "b")
    got = ordered.lagged(skewed, {"a": ("v", 1), "b": ("v", 3)}, ["id"], ["k"], -1.0, slices=slices)
    assert rows(got, "id", "a", "b") == want


def test_running_total_matches_window(skewed, rows):
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows(skewed.withColumn("running", F.sum("v").over(w)), "id", "running")
    assert rows(ordered.running_total(skewed, "v", ["id"], ["k"], slices=9), "id", "running") == want


def test_nearest_marked(spark, rows):
    df = spark.createDataFrame([(s, s % 5 == 0) for s in range(1, 23)], "s int, m boolean")
    got = {r["s"]: (r["at_or_before"], r["at_or_after"]) for r in ordered.nearest_marked(df, F.col("m"), "s", ["s"], slices=5).collect()}
    for s in range(1, 23):
        below = max([x for x in range(5, 23, 5) if x <= s], default=None)
        above = min([x for x in range(5, 23, 5) if x >= s], default=None)
        assert got[s] == (below, above)


@pytest.mark.parametrize("values", [[3.0], [1.0, 9.0], [4.0] * 8, [1, 2, 2, 2, 7], list(range(11)), [5, None, 1, None, 3]])
@pytest.mark.parametrize("cells", [2, 256])
def test_exact_quantiles_interpolate(spark, values, cells):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    probs = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q9": 0.9, "q10": 1.0}
    got = quantiles.exact_quantiles(df, "x", probs, cells=cells).first()
    known = sorted(v for v in values if v is not None)
    for name, p in probs.items():
        pos = p * (len(known) - 1)
        lo, hi = known[int(pos)], known[min(int(pos) + (pos % 1 > 0), len(known) - 1)]
        assert got[name] == pytest.approx(lo + (hi - lo) * (pos % 1))


def test_quantiles_per_key_with_a_hot_key(skewed):
    got = {r["k"]: r["m"] for r in quantiles.exact_quantiles(skewed, "v", {"m": 0.5}, ["k"], cells=4).collect()}
    want = {r["k"]: r["m"] for r in skewed.groupBy("k").agg(F.expr("percentile(v, 0.5)").alias("m")).collect()}
    assert got == want


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, x double")
    assert quantiles.exact_quantiles(empty, "x", {"m": 0.5}).first()["m"] is None
    assert quantiles.exact_quantiles(empty, "x", {"m": 0.5}, ["k"]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 4, 5, 7, 11])
def test_rank_bins_match_equal_share_cuts(spark, n):
    import pandas as pd

    values = [float(v) for v in random.Random(n).choices(range(4), k=n)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    got = {r["id"]: r["bin"] for r in quantiles.with_rank_bins(df, "v", ["id"], 5, "bin").collect()}
    if n == 1:
        assert got == {0: 1}
        return
    ranks = pd.Series(values).rank(method="first")
    want = pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert [got[i] for i in range(n)] == want


def test_rank_bins_of_several_columns_at_once(spark):
    import pandas as pd

    rng = random.Random(5)
    rows = [(i, rng.choice([0, 0, 0, 0, 1, 2, 9]), rng.random(), None if i % 9 == 0 else rng.choice([1.5, 2.5])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, often int, free double, gaps double")
    got = {r["id"]: r for r in quantiles.with_all_rank_bins(df, {"a": "often", "b": "free", "c": "gaps"}, ["id"], 5).collect()}
    for out, column in (("a", 1), ("b", 2), ("c", 3)):
        known = [r for r in rows if r[column] is not None]
        want = pd.qcut(pd.Series([r[column] for r in known]).rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
        assert [got[r[0]][out] for r in known] == want and all(got[r[0]][out] is None for r in rows if r[column] is None)


def test_value_bins_keep_ties_together_and_merge_equal_edges(spark):
    df = spark.createDataFrame([(1.0,)] * 6 + [(2.0,), (3.0,), (4.0,), (None,)], "v double")
    got = {r["v"]: r["b"] for r in quantiles.with_value_bins(df, "v", 5, [5, 4, 3, 2, 1], "b").collect()}
    assert got[1.0] == 5 and got[4.0] == 1 and got[None] is None


def test_rank_bins_leave_missing_values_out(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 1.0), (3, 2.0)], "id int, v double")
    assert rows(quantiles.with_rank_bins(df, "v", ["id"], 5, "bin"), "id", "bin") == [(1, None), (2, 1), (3, 5)]


def test_grids_keep_a_null_key(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (NULL, DATE'2024-01-01', 7), (NULL, DATE'2024-03-01', 8), ('a', DATE'2024-01-01', 1) AS t(k, m, v)")
    assert rows(month_grid(df, ["k"], "m", "v"), "k", "v") == [("a", 1), (None, 0), (None, 7), (None, 8)]
    steps = spark.createDataFrame([(None, 0, 5), (None, 2, 6)], "k string, s int, v int")
    assert rows(step_grid(steps, ["k"], "s", "v"), "v") == [(0,), (5,), (6,)]


def test_group_reports_keep_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    assert {r["g"]: r["median"] for r in box_stats(df, "g", "v").collect()} == {None: 2.0, "a": 2.0}


def test_seasons_without_boundaries_stay(spark, rows):
    matches = spark.createDataFrame([(1, "x"), (2, "y")], "id int, season string")
    balls = spark.createDataFrame([(1, 4), (1, 6), (2, 1)], "id int, batsman_runs int")
    assert rows(season_boundaries(matches, balls), "season", "fours", "sixes", "boundary_runs") == [("x", 1, 1, 10), ("y", 0, 0, 0)]
