"""Profiles, imputation and scaling over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.operators.quantiles import exact_quantiles, quantile_struct
from medalyst.operators.reshape import columns_to_rows


def null_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    """Share of NULLs per column, in one pass."""
    shares = df.agg(*[F.round(F.try_divide(F.count_if(F.col(c).isNull()) * 100.0, F.count(F.lit(1))), digits).alias(c)
                      for c in df.columns])
    return columns_to_rows(shares, df.columns, "column_name", "null_pct")


def numeric_profile(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, mean, spread, extremes and exact quartiles per column, one row each."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in cols])).alias("e")
    ).select("e.*").where("x is not null")
    base = long.groupBy("column_name").agg(
        F.count("x").alias("n"),
        F.round(F.avg("x"), digits).alias("mean"),
        F.round(F.stddev_samp("x"), digits).alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    quartiles = exact_quantiles(long, "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys=["column_name"])
    rounded = quartiles.select("column_name", *[F.round(c, digits).alias(c) for c in ("q1", "median", "q3")])
    return base.join(rounded, "column_name")


def fill_with_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs replaced by the column mean. A zero is a value, not a gap."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in cols})


def fill_with_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULLs replaced by the exact column median."""
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), quantile_struct(df, c, {"m": 0.5})["m"]) for c in cols})


def min_max_scaled(df: DataFrame, value: str | Column, out: str) -> DataFrame:
    """Scale to 0..1 over the table; a constant column becomes 0."""
    x = F.col(value) if isinstance(value, str) else value
    span = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    scaled = F.coalesce(F.try_divide(x - span["lo"], span["hi"] - span["lo"]), F.lit(0.0))
    return df.withColumn(out, F.when(x.isNotNull(), scaled))


def columns_identical(df: DataFrame, left: str, right: str) -> DataFrame:
    """Whether two columns agree on every row, NULLs matching NULLs."""
    differing = F.count_if(~F.col(left).eqNullSafe(F.col(right)))
    return df.agg((differing == 0).alias("identical"), differing.alias("n_different"))


def coerced(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast each column, turning what does not parse into NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
