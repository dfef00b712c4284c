"""Ordered computations that must not put one key, or the whole table, in one task.

A plain window sorts each key in a single task. Here the rows are range
partitioned by (key, order), so a hot key is cut into slices; each slice is
computed on its own and then corrected by a summary holding one row per
(key, slice). The sliced layout is made durable first, because a range
partitioning computed twice may cut at different points.

``order`` should end in a unique column: rows equal in all of it stay together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalyst.session import durable, shuffle_width

SLICE = "_slice"


def sliced(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Cut ``df`` into ordered slices and tag each row with its slice number."""
    by = [*keys, *order]
    laid = df.repartitionByRange(slices or shuffle_width(df.sparkSession), *by)
    return durable(laid.withColumn(SLICE, F.spark_partition_id()))


def _join_on(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join where NULL keys match, keeping the left copies of the keys."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in cols])
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in cols])


def _slice_window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, SLICE).orderBy(*order)


def _with_carry(cut: DataFrame, keys: Sequence[str], value: Column, out: str) -> DataFrame:
    """Attach to each row the total of ``value`` over earlier slices of its key."""
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, SLICE).agg(value.alias("_t"))
    carry = totals.select(*keys, SLICE, F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias(out))
    return _join_on(cut, carry, [*keys, SLICE])


def number_rows(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), out: str = "row_no",
                slices: int | None = None) -> DataFrame:
    """1-based position of each row in ``order``, overall or within ``keys``."""
    cut = sliced(df, order, keys, slices)
    placed = _with_carry(cut, keys, F.count(F.lit(1)), "_carry")
    local = F.row_number().over(_slice_window(keys, order))
    return placed.withColumn(out, (local + F.col("_carry")).cast("bigint")).drop(SLICE, "_carry")


def running_total(df: DataFrame, value: str, order: Sequence[str], keys: Sequence[str] = (), out: str = "running",
                  slices: int | None = None) -> DataFrame:
    """Cumulative sum of ``value`` up to and including each row."""
    cut = sliced(df, order, keys, slices)
    placed = _with_carry(cut, keys, F.sum(value), "_carry")
    upto = _slice_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumn(out, F.sum(value).over(upto) + F.col("_carry")).drop(SLICE, "_carry")


def lagged(df: DataFrame, outputs: dict[str, tuple[str, int]], order: Sequence[str], keys: Sequence[str],
           default=None, slices: int | None = None) -> DataFrame:
    """Earlier values within a key: ``outputs`` maps a new column to (column, steps back).

    Inside a slice the native ``lag`` is right once a row has enough rows before
    it. The first few rows of a slice look back over the slice edges only, which
    hold every row such a look-back can reach.
    """
    reach = max(steps for _, steps in outputs.values())
    cut = sliced(df, order, keys, slices)
    w = _slice_window(keys, order)
    backwards = Window.partitionBy(*keys, SLICE).orderBy(*[F.desc(c) for c in order])
    lags = lambda window: {out: F.lag(c, n, default).over(window) for out, (c, n) in outputs.items()}
    inner = (cut.withColumns({"_from_start": F.row_number().over(w), **lags(w)})
             .where(F.col("_from_start") > reach))
    heads = cut.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= reach).withColumn("_head", F.lit(True))
    tails = (cut.withColumn("_n", F.row_number().over(backwards)).where(F.col("_n") <= reach)
             .withColumn("_head", F.lit(False)))
    # a row of a short slice is both head and tail: keep it once, as a head
    edges = heads.unionByName(_without_heads(tails, cut, keys, reach))
    across = Window.partitionBy(*keys).orderBy(*order)
    first = edges.withColumns(lags(across)).where("_head")
    kept = [*df.columns, *outputs]
    return inner.select(*kept).unionByName(first.select(*kept))


def _without_heads(tails: DataFrame, cut: DataFrame, keys: Sequence[str], reach: int) -> DataFrame:
    sizes = cut.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_size"))
    sized = _join_on(tails, sizes, [*keys, SLICE])
    return sized.where(F.col("_size") - F.col("_n") + 1 > reach).drop("_size")


def nearest_marked(df: DataFrame, marked: Column, value: str, order: Sequence[str], slices: int | None = None
                   ) -> DataFrame:
    """For each row the last marked ``value`` at or before it and the first at or after it,
    in one global order (``value`` must rise along ``order``)."""
    cut = sliced(df.withColumn("_mark", F.when(marked, F.col(value))), order, (), slices)
    w = Window.partitionBy(SLICE).orderBy(*order)
    spans = cut.groupBy(SLICE).agg(F.max("_mark").alias("_top"), F.min("_mark").alias("_bottom"))
    # one row per slice, never more; frames start at the window's edge, so each row adds one step
    up, down = Window.orderBy(SLICE), Window.orderBy(F.desc(SLICE))
    carry = spans.select(
        SLICE,
        F.max("_top").over(up.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.min("_bottom").over(down.rowsBetween(Window.unboundedPreceding, -1)).alias("_after"))
    before = F.max("_mark").over(w.rowsBetween(Window.unboundedPreceding, 0))
    backwards = Window.partitionBy(SLICE).orderBy(*[F.desc(c) for c in order])
    after = F.min("_mark").over(backwards.rowsBetween(Window.unboundedPreceding, 0))
    return (_join_on(cut, carry, [SLICE])
            .withColumns({"at_or_before": F.coalesce(before, "_before"), "at_or_after": F.coalesce(after, "_after")})
            .drop(SLICE, "_mark", "_before", "_after"))
