"""Session settings and the durable scratch area shared by every job."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "medalyst", master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """A session for local runs; on a cluster submit with your own settings instead."""
    master = master or os.environ.get("MEDALYST_MASTER", "local[8]")
    builder = (
        SparkSession.builder.appName(app)
        .master(master)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The reliable folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would live on one machine and die with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="medalyst-")
        atexit.register(shutil.rmtree, _LOCAL_FOLDERS[app], ignore_errors=True)     # made here, so removed here
    return _LOCAL_FOLDERS[app]


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared one."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    A lost executor then costs no recomputation, every later read sees the same
    rows, and the planner knows the real size when it picks a join. Parquet also
    lets each reader take only the columns it uses.
    """
    path = workspace(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
