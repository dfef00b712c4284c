"""Writing tables and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stamped(df: DataFrame, layer: str, as_of: Column | None = None, source: Column | str | None = None) -> DataFrame:
    """Add ``<layer>_ingestion_ts`` and, if given, ``record_source``."""
    out = df.withColumn(f"{layer}_ingestion_ts", F.current_timestamp() if as_of is None else as_of)
    if source is None:
        return out
    return out.withColumn("record_source", source if isinstance(source, Column) else F.lit(source))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Full overwrite; a changed schema replaces the old one."""
    df.write.mode("overwrite").parquet(path)


def replace_dates(df: DataFrame, path: str, date: str) -> None:
    """Overwrite only the dates present in ``df``.

    Rows are spread by date so a date is written by few tasks. The rebalance
    splits a date that holds far more rows than the others.
    """
    (df.hint("rebalance", date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date).parquet(path))


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """An empty table with a schema, unless one is there. True when created."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema
        return False
    except AnalysisException:
        spark.createDataFrame([], schema).write.parquet(path)
        return True


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per task; never gathered into one."""
    df.write.mode("overwrite").option("header", True).csv(path)
