"""Joins and aggregations that take more than one call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.operators.ordered import _join_on as null_safe_join  # noqa: F401  (public name)


def without_keys(df: DataFrame, bad: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not listed; a NULL key never matches, so it stays.

    The listed keys are made distinct first: a key listed very often then
    crosses the shuffle once per task instead of once per row.
    """
    return df.join(bad.select(*keys).distinct(), list(keys), "left_anti")


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of both sides with where they occur."""
    left = a.select(key).distinct().withColumn("_a", F.lit(True))
    right = b.select(key).distinct().withColumn("_b", F.lit(True))
    both = left.join(right, key, "full")
    side = (F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "first only").otherwise("second only"))
    return both.select(key, side.alias("found_in"))


def frequency(df: DataFrame, cols: Sequence[str], out: str = "n") -> DataFrame:
    """Row count per value, NULL values left out."""
    return df.dropna(subset=list(cols)).groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def with_share(df: DataFrame, value: str, out: str, within: Sequence[str] = (), scale: float = 100.0,
               digits: int | None = 2) -> DataFrame:
    """Each row's part of its group's (or the table's) total.

    The total is a second aggregation rather than a window over the group: it
    combines map-side and never gathers a group in one task.
    """
    if within:
        totals = df.groupBy(*within).agg(F.sum(value).alias("_whole"))
        joined, whole = null_safe_join(df, totals, list(within)), F.col("_whole")
    else:
        joined, whole = df, df.agg(F.sum(value)).scalar()
    share = F.try_divide(F.col(value) * F.lit(scale), whole)
    return joined.withColumn(out, share if digits is None else F.bround(share, digits)).drop("_whole")


def with_group_stat(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Attach group aggregates to the detail rows."""
    per_group = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return null_safe_join(df, per_group, list(keys))


def detail_and_overall(df: DataFrame, group: str, keys: Sequence[str], aggs: Sequence[Column],
                       overall: str = "Overall") -> DataFrame:
    """Per-group rows plus the same aggregates over all groups, in one grouping-sets pass."""
    sets = [[F.col(group), *[F.col(k) for k in keys]], [F.col(k) for k in keys]]
    out = df.groupingSets(sets, F.col(group), *[F.col(k) for k in keys]).agg(F.grouping(group).alias("_all"), *aggs)
    label = F.when(F.col("_all") == 1, F.lit(overall)).otherwise(F.col(group))
    return out.withColumn(group, label).drop("_all")


def leader_per_group(df: DataFrame, keys: Sequence[str], pick: str, by: str) -> DataFrame:
    """The ``pick`` with the largest ``by`` in each group, the alphabetically first among equals."""
    from medalyst.operators.dedupe import top_per_key

    return top_per_key(df, keys, [F.desc(by), F.asc(pick)])
