"""Keyed upsert on plain parquet.

A table is a folder of versions, ``upsert_version=<n>/upsert_bucket=<b>/``, and of manifests, ``manifest/version=<n>``. A version holds whole buckets and only
those its batch touched; a manifest names the version of every bucket, the columns and the number of buckets. Spark's ``_SUCCESS`` marker on a
manifest commits a version: nothing that is being read is overwritten, and a failed write leaves the table as it was. One writer at a
time; readers are never blocked.

With a ``date`` column the buckets lie in folders by date, ``upsert_date=<d>/upsert_bucket=<b>``, and a batch reads and writes only the dates it names. The date then belongs to
the key: rows of one key and two dates are two rows.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from medalyst.operators.dedupe import latest_per_key
from medalyst.session import workspace

VERSION, DATE, BUCKET = "upsert_version", "upsert_date", "upsert_bucket"     # must differ from every data column
_NUMBERED = re.compile(r"=(\d+)$")
KEPT_MANIFESTS = 20                                     # older ones are removed when a version is committed


@dataclass(frozen=True)
class Manifest:
    """What one commit says about the whole table."""

    version: int
    buckets: int
    schema: StructType
    current: dict[str, int]                             # cell (a bucket's folder in a version) -> version that holds it

    def rows(self) -> list[tuple[int, int, str, str]]:
        return [(self.version, self.buckets, self.schema.json(), json.dumps(sorted(self.current.items())))]


@dataclass(frozen=True)
class UpsertTable:
    spark: SparkSession
    root: str
    key: str
    buckets: int = 64                                   # of the table, or of each date
    date: str | None = None

    # --- folders and manifests (driver metadata, no data) ----------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path

    def _numbers(self, folder: str) -> list[int]:
        """The numbers that the children of ``folder`` are named by, in one listing."""
        fs, path = self._fs(folder)
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(found.group(1)) for found in map(_NUMBERED.search, names) if found)

    def _remove(self, folder: str) -> None:
        fs, path = self._fs(folder)
        fs.delete(path, True)

    def _data(self, version: int) -> str:
        return f"{self.root}/{VERSION}={version}"

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifest/version={version}"

    def manifest(self) -> Manifest | None:
        """The newest commit."""
        for version in reversed(self._numbers(f"{self.root}/manifest")):
            fs, done = self._fs(f"{self._manifest_path(version)}/_SUCCESS")
            if fs.exists(done):
                row = self.spark.read.schema("version int, buckets int, fields string, current string").json(self._manifest_path(version)).first()
                return Manifest(row["version"], row["buckets"], StructType.fromJson(json.loads(row["fields"])),
                                dict(json.loads(row["current"])))
        return None

    def _commit(self, made: Manifest) -> None:
        frame = self.spark.createDataFrame(made.rows(), "version int, buckets int, fields string, current string")
        frame.coalesce(1).write.json(self._manifest_path(made.version))
        for version in self._numbers(f"{self.root}/manifest")[:-KEPT_MANIFESTS]:
            self._remove(self._manifest_path(version))

    # --- reading and writing --------------------------------------------------
    def exists(self) -> bool:
        return self.manifest() is not None

    @property
    def _cell(self) -> list[str]:
        """The columns that name a cell's folder."""
        return [DATE, BUCKET] if self.date else [BUCKET]

    def _cells(self, folder: str) -> list[str]:
        """The cells that a folder holds, from its listing."""
        fs, path = self._fs("/".join([folder, *[f"{name}=*" for name in self._cell]]))
        depth = len(self._cell)
        return sorted("/".join(status.getPath().toString().split("/")[-depth:]) for status in fs.globStatus(path) or [])

    def _read_cells(self, schema: StructType, wanted: dict[str, int]) -> DataFrame:
        """Rows of (cell, version) copies by the stored columns; a column that a copy lacks is NULL."""
        paths = [f"{self._data(v)}/{cell}" for cell, v in sorted(wanted.items())]
        parts = [StructField(VERSION, IntegerType()), *[StructField(DATE, StringType())] * bool(self.date), StructField(BUCKET, IntegerType())]
        return self.spark.read.schema(StructType([*schema.fields, *parts])).option("basePath", self.root).parquet(*paths)

    def read(self, first_date: str | None = None, last_date: str | None = None) -> DataFrame:
        """The table, or its rows of some dates (both included): no other folder is listed or read."""
        held = self.manifest()
        if held is None:
            raise LookupError(f"no committed table in {self.root}")
        wanted = held.current
        if first_date or last_date:
            day = lambda cell: cell.split("/")[0].split("=")[1]
            wanted = {cell: v for cell, v in wanted.items() if (first_date or "") <= day(cell) <= (last_date or "9")}
        if not wanted:
            return self.spark.createDataFrame([], held.schema)
        return self._read_cells(held.schema, wanted).drop(VERSION, *self._cell)

    def _placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns of its cell; rows without a date lie together in ``none``."""
        if self.date:
            df = df.withColumn(DATE, F.coalesce(F.to_date(self.date).cast("string"), F.lit("none")))
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _columns(self, batch: DataFrame, held: Manifest | None, widen: bool) -> StructType:
        """The table's columns after this batch; raises if the batch does not fit."""
        if held is None:
            return batch.schema
        if held.buckets != self.buckets:
            raise ValueError(f"the table has {held.buckets} buckets, not {self.buckets}")
        old = {f.name: f for f in held.schema}
        wrong = [f.name for f in batch.schema if f.name in old and f.dataType != old[f.name].dataType]
        new = [f for f in batch.schema if f.name not in old]
        missing = [name for name in old if name not in batch.columns]
        if wrong or (new or missing) and not widen:
            raise ValueError(f"columns differ from the table's: types {wrong}, new {[f.name for f in new]}, missing {missing}")
        return StructType([*held.schema.fields, *new])

    def merge(self, batch: DataFrame, newest_by: str | None = None, keep_null_keys: bool = False, widen: bool = False) -> list[str]:
        """Replace rows whose key the batch holds, add the others. Returns the touched cells.

        The batch must hold one row per key, unless ``newest_by`` names a version
        column: then the newest row of each key wins, so late older rows and
        repeated batches change nothing. A NULL key matches nothing, so such a row
        would be added again by every run; it is left out unless asked for. The batch must have the table's columns; with
        ``widen`` new columns join the table, NULL in older rows, and columns that the batch lacks are NULL in its rows.
        """
        held = self.manifest()
        schema = self._columns(batch, held, widen)
        whole = batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in batch.columns}).select(*schema.names)
        # read twice and must be the same rows both times: a cell missed here would lose its old rows
        step = workspace(self.spark, "upsert-batch")
        self._placed(whole if keep_null_keys else whole.where(F.col(self.key).isNotNull())).write.partitionBy(*self._cell).parquet(step)
        touched = self._cells(step)
        if not touched:
            return []
        parts = [*[StructField(DATE, StringType())] * bool(self.date), StructField(BUCKET, IntegerType())]
        source = self.spark.read.schema(StructType([*schema.fields, *parts])).parquet(step)
        before = held.current if held else {}
        current = {cell: before[cell] for cell in touched if cell in before}
        old = self._read_cells(schema, current).drop(VERSION) if current else None
        if newest_by:
            versions = source if old is None else old.unionByName(source)
            merged = latest_per_key(versions, [*self._cell, self.key], newest_by)
        elif old is not None:
            merged = old.join(source.select(*self._cell, self.key), [*self._cell, self.key], "left_anti").unionByName(source)
        else:
            merged = source
        version = max([*self._numbers(self.root), *self._numbers(f"{self.root}/manifest")], default=0) + 1
        merged.hint("rebalance", *self._cell).write.partitionBy(*self._cell).parquet(self._data(version))
        self._remove(step)
        self._commit(Manifest(version, self.buckets, StructType([StructField(f.name, f.dataType) for f in schema]),
                              before | dict.fromkeys(touched, version)))
        return touched

    def vacuum(self) -> list[int]:
        """Remove versions that the newest manifest does not name; readers of older manifests must be done. Returns the removed ones."""
        held = self.manifest()
        gone = [v for v in self._numbers(self.root) if held and v < held.version and v not in set(held.current.values())]
        for version in gone:
            self._remove(self._data(version))
        return gone
