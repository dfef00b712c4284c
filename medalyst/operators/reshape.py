"""Between long and wide, unions with a source tag, and calendar grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.operators.relational import null_safe_join


def columns_to_rows(df: DataFrame, cols: Sequence[str], name: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` to (name, value) rows."""
    return df.unpivot(list(keep), list(cols), name, value)


def rows_to_columns(df: DataFrame, keys: Sequence[str], by: str, values: Sequence, agg: Column, fill=None) -> DataFrame:
    """Pivot over a stated list of values, so no extra job looks them up."""
    wide = df.groupBy(*keys).pivot(by, list(values)).agg(agg)
    return wide if fill is None else wide.fillna(fill, subset=[str(v) for v in values])


def tagged_union(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack frames by column name with their label; columns missing in one become NULL."""
    parts = [df.withColumn(tag, F.lit(label)) for label, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stacked_roles(df: DataFrame, roles: Sequence[str], out: str, keep: Sequence[str] = ()) -> DataFrame:
    """Several columns holding the same kind of thing, as one column of rows."""
    return df.select(*keep, F.explode(F.array(*roles)).alias(out))


def month_grid(df: DataFrame, keys: Sequence[str], month: str, value: str, shared_span: bool = False) -> DataFrame:
    """Fill the months missing between a key's first and last month with zero.

    ``df`` holds one row per key and month. With ``shared_span`` every key runs
    over the months of the whole table.
    """
    if shared_span:
        span = df.agg(F.struct(F.min(month).alias("lo"), F.max(month).alias("hi"))).scalar()
        spans = df.select(*keys).distinct().withColumns({"_lo": span["lo"], "_hi": span["hi"]})
    else:
        spans = df.groupBy(*keys).agg(F.min(month).alias("_lo"), F.max(month).alias("_hi"))
    grid = spans.select(*keys, F.explode(F.expr("sequence(_lo, _hi, interval 1 month)")).alias(month))
    return (null_safe_join(grid, df.select(*keys, month, value), [*keys, month], "left")
            .withColumn(value, F.coalesce(value, F.lit(0))))


def step_grid(df: DataFrame, keys: Sequence[str], step: str, value: str) -> DataFrame:
    """Fill the missing integers from 0 to each key's largest step with zero."""
    spans = df.groupBy(*keys).agg(F.max(step).alias("_hi"))
    grid = spans.select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_hi").cast("bigint"))).alias(step))
    known = df.select(*keys, F.col(step).cast("bigint").alias(step), value)
    return null_safe_join(grid, known, [*keys, step], "left").withColumn(value, F.coalesce(value, F.lit(0)))
