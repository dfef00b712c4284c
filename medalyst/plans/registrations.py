"""Vehicle registration analytics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.functions.columns import exact_avg, lookup, tidy_multi_value, wkt_point
from medalyst.operators.dedupe import top_per_key
from medalyst.operators.quantiles import exact_quantiles
from medalyst.operators.relational import frequency, leader_per_group, null_safe_join, with_share


def located(df: DataFrame, point: str) -> DataFrame:
    lon, lat = wkt_point(point)
    return df.withColumns({"longitude": lon, "latitude": lat})


def relabelled(df: DataFrame, column: str, labels: Mapping[str, str]) -> DataFrame:
    """Short labels where the table has one, the original elsewhere."""
    return df.withColumn(column, F.coalesce(lookup(column, labels), F.col(column)))


def top_counts(df: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    """The ``k`` commonest values, ties in value order."""
    return frequency(df, cols).orderBy(F.desc("n"), *cols).limit(k)


def mean_count_per(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Mean number of rows per inner value within each outer one."""
    return frequency(df, [outer, inner]).groupBy(outer).agg(
        F.round(F.avg("n"), 4).alias("avg_per_group"), F.count(F.lit(1)).alias("groups"))


def dominant(df: DataFrame, place: str, what: str) -> DataFrame:
    """The commonest value in each place."""
    return leader_per_group(frequency(df, [place, what]), [place], what, "n")


def longest_range(df: DataFrame) -> DataFrame:
    """Each model's version with the longest range (then the newest, then by make)."""
    versions = df.groupBy("model", "make", "model_year", "electric_range").agg(F.count(F.lit(1)).alias("registered"))
    return top_per_key(versions, ["model"], [F.desc("electric_range"), F.desc("model_year"), F.asc("make")])


def mix(df: DataFrame, column: str) -> DataFrame:
    """Counts and percent per value."""
    return with_share(frequency(df, [column]), "n", "pct")


def histogram(df: DataFrame, value: str | Column, bins: int) -> DataFrame:
    """Equal-width counts over the column's span; the last bin is closed."""
    x = F.col(value) if isinstance(value, str) else value
    known = df.select(x.cast("double").alias("x")).where("x is not null")
    span = known.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    step = F.floor(F.try_divide((F.col("x") - span["lo"]) * bins, span["hi"] - span["lo"]))
    return known.groupBy(F.least(F.coalesce(step, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))


def utility_counts(df: DataFrame, column: str) -> DataFrame:
    return frequency(df.select(tidy_multi_value(column).alias("utility")), ["utility"])


def mean_by(df: DataFrame, by: Sequence[str], value: str, out: str, k: int | None = None, positive: bool = False
            ) -> DataFrame:
    """Mean per group, zeros counted; ``positive`` then drops groups whose mean is zero."""
    means = df.groupBy(*by).agg(F.round(exact_avg(value), 2).alias(out))
    if positive:
        means = means.where(F.col(out) > 0)
    return means if k is None else means.orderBy(F.desc(out), *by).limit(k)


def above_average_places(df: DataFrame, place: str, kind: str, main: str, other: str) -> DataFrame:
    """Places whose count of ``main`` exceeds the mean over places that have it, and that have ``other`` too."""
    counts = df.groupBy(place).agg(F.count_if(F.col(kind) == main).alias("main_count"),
                                   F.count_if(F.col(kind) == other).alias("other_count"))
    mean = counts.where("main_count > 0").agg(F.avg("main_count")).scalar()
    return counts.where((F.col("main_count") > mean) & (F.col("other_count") > 0))


def eligible_share(df: DataFrame, place: str, column: str, eligible: str) -> DataFrame:
    """Percent of rows with the eligible label per place, places with none left out."""
    shares = df.groupBy(place).agg(F.bround(
        F.count_if(F.col(column) == eligible) * 100.0 / F.count(F.lit(1)), 2).alias("eligible_pct"))
    return shares.where("eligible_pct > 0")


def price_and_count(df: DataFrame, place: str, price: str) -> DataFrame:
    return df.groupBy(place).agg(F.round(exact_avg(price), 2).alias("avg_price"), F.count(F.lit(1)).alias("vehicles"))


def box_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Five-number summary per group."""
    quartiles = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys=[by])
    ends = df.groupBy(by).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n"))
    return null_safe_join(ends, quartiles, [by]).select(
        by, "n", "low", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "high")

