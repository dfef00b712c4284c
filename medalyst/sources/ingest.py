"""Landing files into a bronze table, each file once, without a list of files on the driver.

Spark's file source finds the new files and its checkpoint remembers them. A batch of files becomes the folder ``ingest_batch=<n>`` of the data, parted into
accepted and rejected rows and by load date, and then a folder of the same number in the tracker, with one row for each file that was read. A batch counts
once its tracker folder is complete; a crash in between leaves a batch that nobody sees, and the next run writes the same files under the same number over it. A batch that fails leaves one row
with the cause, and the next run tries its files again.

A malformed field does not become NULL unseen: a line that does not fit the schema goes to the rejected rows as it stood in the file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalyst.contracts import FILE_TRACKER
from medalyst.sources.readers import CORRUPT, list_files
from medalyst.sources.writers import append

BATCH, DATE, OUTCOME = "ingest_batch", "bronze_date", "outcome"
LOADED, SOURCE = "bronze_ingestion_ts", "source_file"
TRACKER = T.StructType([*FILE_TRACKER.fields, T.StructField("n_rows", T.LongType()), T.StructField("n_rejected", T.LongType()),
                        T.StructField("cause", T.StringType())])


@dataclass(frozen=True)
class Bronze:
    """A bronze table below ``root``, fed by the CSV files that land in ``folder``."""

    spark: SparkSession
    table: str
    folder: str
    schema: T.StructType
    root: str
    glob: str = "*.csv"
    files_per_batch: int | None = None

    def _stream(self) -> DataFrame:
        reader = (self.spark.readStream.format("csv").option("header", True).option("mode", "PERMISSIVE").option("pathGlobFilter", self.glob)
                  .option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True)
                  .schema(T.StructType([*self.schema.fields, T.StructField(CORRUPT, T.StringType())])))
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        return reader.load(self.folder).withColumn(SOURCE, F.col("_metadata.file_path"))

    def write_rows(self, batch: DataFrame, number: int, loaded_at: Column | None = None) -> DataFrame:
        """The rows of one batch below its own folder; written again, they replace what was there."""
        path = f"{self.root}/data/{BATCH}={number}"
        stamp = (F.current_timestamp() if loaded_at is None else loaded_at).cast("timestamp")
        (batch.withColumn(LOADED, stamp).withColumns({OUTCOME: F.when(F.col(CORRUPT).isNull(), "accepted").otherwise("rejected"), DATE: F.to_date(LOADED)})
         .write.mode("overwrite").partitionBy(OUTCOME, DATE).parquet(path))
        return self.spark.read.schema(self._stored()).option("basePath", f"{self.root}/data").parquet(path)

    def write_tracker(self, rows: DataFrame, number: int) -> None:
        """One row for each file that the batch read; this commits the batch."""
        done = rows.groupBy(F.col(SOURCE).alias("file_path")).agg(
            F.max(LOADED).alias("ingestion_ts"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(OUTCOME) == "rejected").alias("n_rejected"))
        done = done.withColumns({"table_name": F.lit(self.table), "status": F.lit("SUCCESS"), "cause": F.lit(None).cast("string")})
        done.select(*TRACKER.names).write.mode("overwrite").parquet(f"{self.root}/tracker/{BATCH}={number}")

    def run(self, loaded_at: Column | None = None) -> str:
        """Load every file that has landed since the last run: SUCCESS, NOTHING_NEW or FAILED (with a row that tells the cause)."""
        seen: list[int] = []
        try:
            stream = self._stream()
        except AnalysisException:               # no such folder: nothing has landed yet
            return "NOTHING_NEW"

        def load(batch: DataFrame, number: int) -> None:
            seen.append(number)
            self.write_tracker(self.write_rows(batch, number, loaded_at), number)

        try:
            writer = stream.writeStream.option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True)
            writer.foreachBatch(load).start().awaitTermination()
        except (AnalysisException, StreamingQueryException) as failure:
            row = (self.table, "BATCH_FAILURE", "FAILED", None, None, None, str(failure)[:4000])
            append(self.spark.createDataFrame([row], TRACKER).withColumn("ingestion_ts", F.current_timestamp()), f"{self.root}/failures")
            return "FAILED"
        return "SUCCESS" if seen else "NOTHING_NEW"

    # --- reading --------------------------------------------------------------
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(CORRUPT, T.StringType()), T.StructField(SOURCE, T.StringType()),
                             T.StructField(LOADED, T.TimestampType()), T.StructField(BATCH, T.IntegerType()), T.StructField(OUTCOME, T.StringType()),
                             T.StructField(DATE, T.DateType())])

    def _folder(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def loaded(self) -> DataFrame:
        """One row for each file of a committed batch."""
        return self._folder("tracker", T.StructType([*TRACKER.fields, T.StructField(BATCH, T.IntegerType())]))

    def tracker(self) -> DataFrame:
        """All tracker rows: files that were loaded and batches that failed."""
        return self.loaded().drop(BATCH).unionByName(self._folder("failures", TRACKER))

    def all_rows(self) -> DataFrame:
        """Accepted and rejected rows of the committed batches."""
        return self._folder("data", self._stored()).join(self.loaded().select(BATCH).distinct(), BATCH, "left_semi")

    def read(self) -> DataFrame:
        """The bronze table; a filter on ``bronze_date`` reads only those dates' folders."""
        return self.all_rows().where(F.col(OUTCOME) == "accepted").drop(OUTCOME, BATCH, CORRUPT)

    def rejected(self) -> DataFrame:
        """Lines that do not fit the schema, as they stood in their file."""
        return self.all_rows().where(F.col(OUTCOME) == "rejected").select(F.col(CORRUPT).alias("line"), SOURCE, LOADED, DATE)

    def waiting(self) -> DataFrame:
        """Files that have landed and that no committed batch holds. File names only; no content is read."""
        try:
            listed = list_files(self.spark, self.folder, self.glob, nested=True)
        except AnalysisException:
            return self.spark.createDataFrame([], "file_path string, modificationTime timestamp, length bigint")
        return listed.join(self.loaded().select("file_path"), "file_path", "left_anti")
