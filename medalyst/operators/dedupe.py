"""One row per key, chosen by an explicit order.

``row_number() <= k`` is planned with a group limit before the shuffle, so each
map task forwards at most k rows per key however hot the key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1,
                rank_as: str | None = None) -> DataFrame:
    rank = rank_as or "_rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
    return kept if rank_as else kept.drop(rank)


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest version of each key; equal versions are decided by ``tiebreak``, largest first."""
    return top_per_key(df, keys, [F.desc_nulls_last(version), *[F.desc_nulls_last(c) for c in tiebreak]])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once with their counts; a NULL key counts as a key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
