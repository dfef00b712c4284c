"""Reading files and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalyst.contracts import FILE_TRACKER

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
             keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header. With a schema a malformed field becomes NULL, and ``keep_corrupt``
    keeps the raw line of such a row; without one the types are inferred in an extra pass."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(paths)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("mode", "PERMISSIVE").schema(schema).csv(paths)


def list_files(spark: SparkSession, folder: str, glob: str = "*", nested: bool = False) -> DataFrame:
    """The files below a folder as a frame; no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", nested).load(folder)
            .select(F.col("path").alias("file_path"), "modificationTime", "length"))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType = FILE_TRACKER) -> DataFrame:
    """A few rows with stated types, so an all-NULL column keeps its type."""
    return spark.createDataFrame(list(rows), schema)


def jdbc_options(url: str, table: str, split: Mapping[str, object] | None = None, fetch_size: int = 10_000,
                 **more: str) -> dict[str, str]:
    """Reader options for one table. ``split`` (column, lower, upper, partitions) makes the
    read parallel; without it one task reads the whole table."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **more}
    if split:
        options.update(partitionColumn=str(split["column"]), lowerBound=str(split["lower"]),
                       upperBound=str(split["upper"]), numPartitions=str(split["partitions"]))
    return options


def read_database(spark: SparkSession, url: str, schema: str, splits: Mapping[str, Mapping] | None = None,
                  **more: str) -> dict[str, DataFrame]:
    """Every table of a database schema as a lazy frame named ``schema.table``."""
    names = (spark.read.format("jdbc")
             .options(**jdbc_options(url, "information_schema.tables", **more)).load()
             .where(F.col("table_schema") == schema).select("table_name"))
    found = [row[0] for row in names.collect()]     # catalog entries, not data
    return {f"{schema}.{t}": spark.read.format("jdbc").options(
        **jdbc_options(url, f"{schema}.{t}", (splits or {}).get(t), **more)).load() for t in found}


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Fail early, naming every table a job depends on and cannot find."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise LookupError(f"tables not found: {', '.join(missing)}")
