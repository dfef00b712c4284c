"""Streaming ingest, dedupe, demand, gate and upsert.

Every job runs on what has arrived (``availableNow``) and can be run again: file
sinks commit each batch once, and the batch writers below are idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalyst.contracts import Contract
from medalyst.operators.dedupe import latest_per_key
from medalyst.operators.quality import check_results, quarantined, with_validity
from medalyst.sources.upsert import UpsertTable


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "csv", files_per_batch: int | None = None,
                glob: str | None = None) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def run_available(stream: DataFrame, checkpoint: str, path: str | None = None, per_batch: Callable | None = None,
                  mode: str = "append") -> None:
    """Process everything that has arrived, into parquet files or a batch function."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True)
    started = writer.foreachBatch(per_batch).start() if per_batch else writer.format("parquet").start(path)
    started.awaitTermination()


def ingest(spark: SparkSession, folder: str, schema: T.StructType, target: str, checkpoint: str, fmt: str = "csv",
           files_per_batch: int | None = None) -> None:
    """Bronze ingest, each file exactly once: the checkpoint takes the place of a file tracker."""
    rows = file_stream(spark, folder, schema, fmt, files_per_batch)
    stamped = rows.withColumns({"source_file": F.col("_metadata.file_path"), "bronze_ingestion_ts": F.current_timestamp()})
    run_available(stamped, checkpoint, path=target)


def _watermarked(stream: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp; a zoneless one is read in the session's zone."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first arrival of each key; state is kept for ``delay`` of event time."""
    kept = _watermarked(stream, event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    return kept.withColumn(event_time, F.col(event_time).cast(stream.schema[event_time].dataType))


def windowed_demand(stream: DataFrame, event_time: str, by: Sequence[str], length: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Count per group and tumbling window; rows later than ``delay`` are left out."""
    counts = _watermarked(stream, event_time, delay).groupBy(F.window(event_time, length), *by).agg(F.count(F.lit(1)).alias("n_orders"))
    start = F.col("window.start").cast(stream.schema[event_time].dataType)
    return counts.select(start.alias("window_start"), *by, "n_orders")


def gate_batches(contract: Contract, good: str, bad: str, log: str, ingest_column: str = "bronze_ingestion_ts") -> Callable:
    """Batch function: valid rows, quarantine and check results, each below its own batch folder.

    A replayed batch overwrites its folders, so nothing is written twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            flagged = with_validity(batch, contract)
            kept = flagged.where(F.coalesce("is_valid", F.lit(False))).drop("is_valid")
            kept.write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
            quarantined(flagged).write.mode("overwrite").parquet(f"{bad}/batch={batch_id}")
            check_results(batch, contract, ingest_column=ingest_column).write.mode("overwrite").parquet(f"{log}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def upsert_batches(table: UpsertTable, version: str) -> Callable:
    """Batch function: newest row per key into the table; late older rows lose."""

    def write(batch: DataFrame, _batch_id: int) -> None:
        table.merge(latest_per_key(batch, [table.key], version), newest_by=version)

    return write
