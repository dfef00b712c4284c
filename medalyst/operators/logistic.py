"""Logistic regression of every group at once.

Each Newton step is one grouped aggregation: the weighted cross products of the features and the scores of each group, under that group's
coefficients, and at the same time under those of the fit over all rows. The small systems are solved in a grouped frame, so the number of groups has no limit.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalyst.functions.distributions import normal_p
from medalyst.operators.relational import null_safe_join
from medalyst.session import durable

Z95 = 1.959963984540054
STEPS, TOLERANCE = 25, 1e-9


def _matrix(products: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((k, k))
    out[np.triu_indices(k)] = products
    return out + np.triu(out, 1).T


def newton(sums: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """New coefficients, their covariance and the largest move, from the cross products (upper triangle) and the scores."""
    k = len(beta)
    cov = np.linalg.pinv(_matrix(sums[:-k], k), hermitian=True)
    move = cov @ sums[-k:]
    return beta + move, cov, float(np.abs(move).max())


_FIT = T.StructType([T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("cov", T.ArrayType(T.DoubleType())), T.StructField("move", T.DoubleType())])


@F.pandas_udf(_FIT)
def _newton(sums: pd.Series, beta: pd.Series) -> pd.DataFrame:
    found = [newton(np.asarray(s, float), np.asarray(b, float)) for s, b in zip(sums, beta, strict=True)]
    return pd.DataFrame({"beta": [b.tolist() for b, _, _ in found], "cov": [c.ravel().tolist() for _, c, _ in found], "move": [m for _, _, m in found]})


def _sums(k: int, beta: Column) -> Column:
    """Weighted cross products and scores of the rows ``x`` (with a constant), ``y`` under ``beta``."""
    x = [F.get("x", F.lit(i)) for i in range(k)]
    eta = sum((x[i] * F.get(beta, F.lit(i)) for i in range(k)), F.lit(0.0))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(eta, F.lit(35.0)), F.lit(-35.0))))
    return F.array(*[F.sum(p * (1 - p) * x[i] * x[j]) for i in range(k) for j in range(i, k)], *[F.sum((F.col("y") - p) * x[i]) for i in range(k)])


def fitted(df: DataFrame, label: str, features: Sequence[str], group: str, steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[DataFrame, dict]:
    """``g, beta, cov, n_rows, converged`` of each group (a NULL group is one), and the same of the fit over all rows.

    The first coefficient is the constant. Rows with a NULL label or feature take no part.
    """
    k = len(features) + 1
    # every step reads the rows again, so the narrow table is written once
    values = [F.col(f).cast("double") for f in features]
    rows = durable(df.select(F.col(group).cast("string").alias("g"), F.col(label).cast("double").alias("y"), F.array(F.lit(1.0), *values).alias("x"))
                   .where(F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull())))
    zero = F.array(*[F.lit(0.0)] * k)
    groups, whole = None, {"beta": np.zeros(k), "cov": np.zeros((k, k)), "move": np.inf, "n_rows": 0}
    for _ in range(steps):
        placed = rows.withColumn("beta", zero) if groups is None else null_safe_join(rows, groups.select("g", "beta"), ["g"])
        shared = F.array(*[F.lit(float(b)) for b in whole["beta"]])
        sums = placed.groupBy("g").agg(F.first("beta").alias("old"), _sums(k, F.col("beta")).alias("own"), _sums(k, shared).alias("all"),
                                       F.count(F.lit(1)).alias("n_rows"))
        groups = durable(sums.withColumn("fit", _newton("own", "old")).select("g", "fit.*", "all", "n_rows"))
        size = k * (k + 1) // 2 + k
        total = groups.agg(F.max("move").alias("move"), F.sum("n_rows").alias("n_rows"), *[F.sum(F.get("all", F.lit(i))).alias(f"s{i}") for i in range(size)]).first()
        if total["n_rows"] is None:
            break
        beta, cov, move = newton(np.array([total[f"s{i}"] for i in range(size)]), whole["beta"])
        whole = {"beta": beta, "cov": cov, "move": move, "n_rows": total["n_rows"]}
        if max(move, total["move"]) < tolerance:
            break
    return groups.drop("all").withColumn("converged", F.col("move") < tolerance).drop("move"), whole | {"converged": whole["move"] < tolerance}


def odds_ratios(df: DataFrame, label: str, features: Sequence[str], group: str, overall: str = "Overall") -> DataFrame:
    """Odds ratio of each feature per group and over all rows, with 95% interval and p-value; ``converged`` is false where the labels part perfectly."""
    groups, whole = fitted(df, label, features, group)
    k = len(features) + 1
    every = df.sparkSession.createDataFrame(
        [(overall, whole["beta"].tolist(), whole["cov"].ravel().tolist(), int(whole["n_rows"]), bool(whole["converged"]))] * bool(whole["n_rows"]),
        "g string, beta array<double>, cov array<double>, n_rows bigint, converged boolean")
    terms = F.array(*[F.struct(F.lit(name).alias("term"), F.get("beta", F.lit(i)).alias("b"), F.sqrt(F.get("cov", F.lit(i * k + i))).alias("se"))
                      for i, name in [*enumerate(features, 1), (0, "const")]])
    long = groups.select(*every.columns).unionByName(every).select(F.col("g").alias("part"), "n_rows", "converged", F.explode(terms).alias("t"))
    b, se = F.col("t.b"), F.col("t.se")
    return long.select("part", F.col("t.term").alias("term"), F.exp(b).alias("odds_ratio"), F.exp(b - Z95 * se).alias("low"), F.exp(b + Z95 * se).alias("high"),
                       normal_p(F.try_divide(b, se)).alias("p_value"), "n_rows", "converged")
