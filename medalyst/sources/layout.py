"""Clustered writes: rows near each other in several columns land in the same files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalyst.operators.quantiles import cell_edges, into_cells

FILE_BYTES = 128 << 20        # of rows in a range, as its task holds them to sort; files are smaller


def order_code(df: DataFrame, name: str) -> Column:
    """A double that rises with a number, date or time column."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def text_cell(df: DataFrame, name: str, cells: int) -> Column:
    """The cell of a text value among range bounds of the distinct values, compared as whole texts."""
    ranged = df.select(name).where(F.col(name).isNotNull()).distinct().repartitionByRange(cells, name)
    tops = ranged.withColumn("_part", F.spark_partition_id()).groupBy("_part").agg(F.max(name).alias("top")).collect()   # ``cells`` rows
    bounds = sorted(row["top"] for row in tops)[:-1]
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(name)))


def interleaved(cells: Sequence[str], bits: int) -> Column:
    """Z-order value: the bits of the cell numbers, most significant first, taken in turn."""
    terms = [F.shiftleft(F.shiftright(F.coalesce(F.col(c), F.lit(0)).cast("bigint"), b).bitwiseAND(F.lit(1)),
                         b * len(cells) + i)
             for b in range(bits) for i, c in enumerate(reversed(cells))]
    return reduce(lambda a, b: a.bitwiseOR(b), terms)


def with_cluster_value(df: DataFrame, cols: Sequence[str], bits: int = 6, out: str = "_z") -> DataFrame:
    """Tag rows with the z-order value of their per-column quantile cells."""
    cells = [f"_cell{i}" for i in range(len(cols))]
    text = {i for i, name in enumerate(cols) if isinstance(df.schema[name].dataType, T.StringType)}
    codes = {i: f"_code{i}" for i in range(len(cols)) if i not in text}
    placed = df.withColumns({code: order_code(df, cols[i]) for i, code in codes.items()}) if codes else df
    edges = cell_edges(placed, list(codes.values()), 2 ** bits) if codes else []
    for (i, code), cut in zip(codes.items(), edges):
        placed = into_cells(placed, code, cut, cells[i]).drop(code)
    for i in sorted(text):
        placed = placed.withColumn(cells[i], text_cell(df, cols[i], 2 ** bits))
    return placed.withColumn(out, interleaved(cells, bits)).drop(*cells)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in a sort: texts, bytes and nested values by their length, other columns by a word each."""
    size = F.lit(32 + 16 * len(df.columns))
    for field in df.schema:
        c = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size.cast("bigint")


def clustered(df: DataFrame, cols: Sequence[str], files: int, bits: int = 6) -> DataFrame:
    """``df`` laid out in at least ``files`` ranges of the z-order value, sorted inside each.

    A range holds about ``FILE_BYTES`` of rows at most: a larger table gets more files, not larger tasks. Row-group statistics then let a filter on
    any of ``cols`` skip most of the data. The range also cuts on the columns themselves and then on the other plain columns, so one very frequent
    value, or combination of values, is spread over several files.
    """
    total = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    tagged = with_cluster_value(df, cols, bits)
    plain = ["`" + f.name.replace("`", "``") + "`" for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    ranged = tagged.repartitionByRange(max(files, -(-total // FILE_BYTES)), "_z", *cols, F.xxhash64(*plain))
    return ranged.sortWithinPartitions("_z", *cols).drop("_z")


def file_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """What each file of a table holds: ``file, n_rows`` and the least and greatest value of ``cols``."""
    ends = [f(c).alias(f"{name}_{c}") for c in cols for name, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), *ends)


def files_touched(ranges: DataFrame, wanted: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """For each column and its filter (both ends included): how many files the table has and how many of them the filter has to read."""
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), ((F.col(f"min_{c}") <= high) & (F.col(f"max_{c}") >= low)).alias("touched"))
                     for c, (low, high) in wanted.items()])
    long = ranges.select("n_rows", F.explode(rows).alias("r")).select("n_rows", "r.*")
    return long.groupBy("column_name").agg(F.count(F.lit(1)).alias("files"), F.count_if("touched").alias("files_read"), F.sum("n_rows").alias("n_rows"))
