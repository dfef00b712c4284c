"""Column helpers, profiles and reshaping on small edge-case frames."""

import pytest
from pyspark.sql import functions as F

from medalyst.functions import columns as c
from medalyst.operators import cleaning, relational, reshape


def test_text_helpers(spark):
    df = spark.createDataFrame([("  aB c ", "X||y|Z"), ("", None)], "t string, m string")
    got = df.select(c.tidy("t", "upper"), c.tidy("t", "title"), c.tidy_multi_value("m")).collect()
    assert tuple(got[0]) == ("AB C", "Ab C", "X, Y, Z")
    assert tuple(got[1]) == ("", "", "Unknown")


@pytest.mark.parametrize("text,want", [("POINT (-122.3 47.6)", (-122.3, 47.6)), ("POINT EMPTY", (None, None)), (None, (None, None))])
def test_wkt_point(spark, text, want):
    lon, lat = c.wkt_point("p")
    assert tuple(spark.createDataFrame([(text,)], "p string").select(lon, lat).first()) == want


def test_rounding_modes_differ_on_ties(spark):
    df = spark.createDataFrame([(1, 800), (5, 800)], "a int, b int")        # 0.125 and 0.625 percent
    got = df.select(c.pct("a", "b"), c.pct("a", "b", half_even=True)).collect()
    assert [tuple(r) for r in got] == [(0.13, 0.12), (0.63, 0.62)]


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert df.select(c.pct("a", "b")).first()[0] is None


def test_clip_keeps_null_and_row_total_treats_it_as_zero(spark):
    df = spark.createDataFrame([(None, 4.0), (9.0, None)], "a double, b double")
    got = df.select(c.clip("a", 0.0, 5.0), c.row_total(["a", "b"])).collect()
    assert [tuple(r) for r in got] == [(None, 4.0), (5.0, 9.0)]


def test_exact_sum_ignores_order_and_null(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,), (-0.3,)], "x double")
    assert df.agg(c.exact_sum("x")).first()[0] == 0.7
    assert spark.createDataFrame([], "x double").agg(c.exact_sum("x")).first()[0] is None


def test_lookup_and_one_hot(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    got = df.select(c.lookup("k", {"a": 1, "b": 2}, 0), *c.one_hot("k", ["a", "b", "z"], "k")).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0), (0, 0, 1), (0, 0, 0)]


def test_on_time_is_three_valued(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00' AS due, d FROM VALUES (TIMESTAMP '2024-01-01 10:00'), (TIMESTAMP '2024-01-01 10:01'), (NULL) AS t(d)")
    assert [r[0] for r in df.select(c.on_time("d", "due")).collect()] == [1, 0, None]


def test_scaling_a_constant_column_gives_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [r["s"] for r in cleaning.min_max_scaled(df, "x", "s").collect()] == [0.0, 0.0, None]


def test_imputation(spark):
    df = spark.createDataFrame([(1.0,), (None,), (0.0,), (5.0,)], "x double")
    assert [r[0] for r in cleaning.fill_with_mean(df, ["x"]).collect()] == [1.0, 2.0, 0.0, 5.0]
    assert [r[0] for r in cleaning.fill_with_median(df, ["x"]).collect()] == [1.0, 1.0, 0.0, 5.0]


def test_identical_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, 1), (None, None)], "a int, b int")
    assert tuple(cleaning.columns_identical(df, "a", "b").first()) == (True, 0)
    assert tuple(cleaning.columns_identical(df.withColumn("b", F.lit(1)), "a", "b").first()) == (False, 1)


def test_month_grid_fills_inner_gaps_only(spark, rows):
    df = spark.sql("SELECT k, DATE(m) AS m, v FROM VALUES ('a', '2024-01-01', 1), ('a', '2024-04-01', 2), ('b', '2024-02-01', 7) AS t(k, m, v)")
    assert [r[2] for r in rows(reshape.month_grid(df, ["k"], "m", "v"))] == [1, 0, 0, 2, 7]
    assert reshape.month_grid(df, ["k"], "m", "v", shared_span=True).count() == 8


def test_overall_rows_do_not_double_count(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), (None, "x", 4)], "g string, k string, v int")
    got = rows(relational.detail_and_overall(df, "g", ["k"], [F.sum("v").alias("v")]))
    assert sorted(got, key=str) == sorted([("Overall", "x", 7), ("a", "x", 1), ("b", "x", 2), (None, "x", 4)], key=str)


def test_null_safe_join_matches_nulls(spark):
    a = spark.createDataFrame([(None, 1), ("k", 2)], "k string, x int")
    b = spark.createDataFrame([(None, 10), ("k", 20)], "k string, y int")
    assert {(r["x"], r["y"]) for r in relational.null_safe_join(a, b, ["k"]).collect()} == {(1, 10), (2, 20)}


def test_share_of_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "k string, n int")
    assert [r["p"] for r in relational.with_share(df, "n", "p").collect()] == [None, None]
