"""Fits over many groups and levels, and the choice among forecasting models."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from medalyst.operators import logistic, series, stats


def newton(x, y):
    x, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ beta))
        cov = np.linalg.inv((x * (p * (1 - p))[:, None]).T @ x)
        beta = beta + cov @ x.T @ (y - p)
    return beta, np.sqrt(np.diag(cov))


def test_logistic_fits_of_many_groups(spark):
    rng = np.random.default_rng(1)
    n = 12_000
    data = pd.DataFrame({"g": rng.integers(0, 120, n).astype(str), "a": rng.normal(size=n), "b": rng.integers(0, 2, n).astype(float)})
    data["y"] = (rng.random(n) < 1 / (1 + np.exp(-(0.3 + 0.8 * data.a - 0.5 * data.b)))).astype(float)
    data.loc[data.g == "7", "g"] = None
    gaps = pd.DataFrame({"g": ["1", "1"], "a": [None, 1.0], "b": [1.0, 1.0], "y": [1.0, None]})
    frame = spark.createDataFrame(pd.concat([data, gaps]).replace({np.nan: None}), "g string, a double, b double, y double")
    found = logistic.odds_ratios(frame, "y", ["a", "b"], "g").collect()
    assert len(found) == 3 * 121 and all(r["converged"] for r in found)
    by = {(r["part"], r["term"]): r for r in found}
    for part, rows in [("Overall", data), (None, data[data.g.isna()]), *[(g, data[data.g == g]) for g in ("0", "1", "119")]]:
        beta, se = newton(rows[["a", "b"]].to_numpy(), rows.y.to_numpy())
        for i, term in enumerate(["const", "a", "b"]):
            r = by[part, term]
            assert r["odds_ratio"] == pytest.approx(math.exp(beta[i]), rel=1e-6) and r["n_rows"] == len(rows)
            assert r["low"] == pytest.approx(math.exp(beta[i] - 1.959963984540054 * se[i]), rel=1e-5)
            assert r["p_value"] == pytest.approx(math.erfc(abs(beta[i] / se[i]) / math.sqrt(2)), abs=1e-6)


def test_labels_that_part_perfectly_are_flagged(spark):
    rows = [("split", float(i), float(i > 5)) for i in range(12)] + [("mixed", float(i), float(i % 2)) for i in range(12)]
    found = logistic.odds_ratios(spark.createDataFrame(rows, "g string, x double, y double"), "y", ["x"], "g").collect()
    assert {r["part"]: r["converged"] for r in found} == {"split": False, "mixed": True, "Overall": True}


def test_logistic_without_rows(spark):
    assert logistic.odds_ratios(spark.createDataFrame([], "g string, x double, y double"), "y", ["x"], "g").collect() == []


def test_anova_with_many_levels_and_missing_factors(spark):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 40, 6000), rng.integers(0, 30, 6000)
    b = np.where(rng.random(6000) < 0.5, a % 30, b)                        # far from balanced
    y = a * 0.1 + b * 0.2 + rng.normal(size=6000)
    rows = [(f"a{i}", f"b{j}", float(v)) for i, j, v in zip(a, b, y, strict=True)] + [(None, "b1", 5.0), ("a1", None, 5.0), ("a1", "b1", None)]
    got = {r["term"]: r for r in stats.two_way_anova(spark.createDataFrame(rows, "a string, b string, y double"), "a", "b", "y").collect()}
    one, da, db = np.ones((6000, 1)), np.eye(40)[a], np.eye(30)[b]

    def rss(*parts):
        x = np.hstack(parts)
        return float(np.sum((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2))

    main = rss(one, da, db)
    assert got["a"]["sum_sq"] == pytest.approx(rss(one, db) - main, rel=1e-8) and got["b"]["sum_sq"] == pytest.approx(rss(one, da) - main, rel=1e-8)
    cells = pd.DataFrame({"a": a, "b": b, "y": y}).groupby(["a", "b"]).y
    full = float((cells.var(ddof=0) * cells.size()).sum())
    assert got["residual"]["sum_sq"] == pytest.approx(full) and got["a:b"]["sum_sq"] == pytest.approx(main - full, rel=1e-7)
    assert (got["a"]["dof"], got["b"]["dof"], got["residual"]["dof"]) == (39, 29, 6000 - cells.ngroups)


def months(values):
    return [("k", pd.Timestamp("2020-01-01") + pd.DateOffset(months=i), v) for i, v in enumerate(values)]


def chosen(spark, values):
    df = spark.createDataFrame(pd.DataFrame(months(values), columns=["k", "month", "total"])).withColumn("month", F.to_date("month"))
    return series.chosen_forecast(df, ["k"]).orderBy("step").collect()


def test_the_model_that_continues_best_is_chosen(spark):
    line = chosen(spark, [10.0 + 3 * i for i in range(12)])
    assert [r["forecast"] for r in line] == pytest.approx([46.0, 49.0, 52.0]) and line[0]["n_points"] == 12 and line[0]["holdout_mae"] == pytest.approx(0, abs=1e-9)
    flat = chosen(spark, [5.0, 7.0, 5.0, 7.0, 5.0, 7.0, 6.0, 6.0])
    assert flat[0]["model"] == "mean" and flat[0]["forecast"] == 6.0
    turned = chosen(spark, [10.0] * 8 + [20.0, 30.0, 40.0, 50.0, 60.0])
    assert turned[0]["model"] == "holt" and turned[0]["alpha"] is not None and turned[0]["forecast"] > 60


def test_short_series_say_what_they_are(spark):
    for values in ([4.0], [4.0, 8.0], [0.0, 0.0, 0.0]):
        rows = chosen(spark, values)
        assert {r["model"] for r in rows} == {"mean"} and rows[0]["n_points"] == len(values) and rows[0]["forecast"] == pytest.approx(sum(values) / len(values))
    assert chosen(spark, [4.0, 8.0])[0]["holdout_mae"] is None


def test_sums_that_are_not_money_are_not_rounded(spark):
    df = spark.createDataFrame([("k", "2024-01-05", 0.004)] * 1000, "k string, day string, v double").withColumn("day", F.to_date("day"))
    assert series.monthly_totals(df, ["k"], "day", "v").first()["total"] == pytest.approx(4.0)
    assert series.monthly_totals(df, ["k"], "day", "v", scale=2).first()["total"] == 0.0
