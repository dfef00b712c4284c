"""XS1-XS5: streams over the event table must equal the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import n, sql
from medalyst.checks.registry import query
from medalyst.contracts import CONTRACTS
from medalyst.session import workspace
from medalyst.sources.upsert import UpsertTable
from medalyst.streaming import jobs


def _arrived(t, df, fmt="parquet", files=4):
    """``df`` as files that have arrived in a folder."""
    folder = f"{workspace(t.spark, 'arrivals')}"
    writer = df.repartition(files).write
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(folder)
    return folder


@query("xs1_file_ingest", sql("SELECT event_id, user_id, value FROM events"))
def _(t):
    rows = t.events.select("event_id", "user_id", "value")
    folder, out = _arrived(t, rows, "csv"), workspace(t.spark, "bronze")
    for _run in range(2):                 # the second run finds nothing new
        jobs.ingest(t.spark, folder, rows.schema, f"{out}/data", f"{out}/checkpoint", files_per_batch=2)
    return t.spark.read.parquet(f"{out}/data").select("event_id", "user_id", "value")


@query("xs2_deduplicated_stream", "SELECT event_id, ts, user_id FROM events")
def _(t):
    rows = t.events.select("event_id", "ts", "user_id")
    folder, out = _arrived(t, rows.unionByName(rows)), workspace(t.spark, "dedupe")
    stream = jobs.file_stream(t.spark, folder, rows.schema, "parquet", files_per_batch=2)
    jobs.run_available(jobs.deduplicated(stream, ["event_id"], "ts", "60 days"), f"{out}/checkpoint", path=f"{out}/data")
    return t.spark.read.parquet(f"{out}/data").select("event_id", "ts", "user_id")


@query("xs3_hourly_demand", sql(f"SELECT date_trunc('hour', created_ts) AS window_start, city, {n()} AS n_orders FROM live_orders GROUP BY ALL", "live_orders"))
def _(t):
    rows = b.live_orders(t).select("order_id", "city", "created_ts")
    folder, out = _arrived(t, rows), workspace(t.spark, "demand")
    stream = jobs.file_stream(t.spark, folder, rows.schema, "parquet", files_per_batch=2)
    demand = jobs.windowed_demand(stream, "created_ts", ["city"], delay="60 days")
    keyed = demand.withColumn("id", F.concat_ws("|", "city", F.col("window_start").cast("string")))
    table = UpsertTable(t.spark, f"{out}/data", "id", buckets=4)
    jobs.run_available(keyed, f"{out}/checkpoint", per_batch=lambda batch, _: table.merge(batch), mode="update")
    return table.read().drop("id")


_DIRTY = """SELECT event_id AS ping_id, user_id - 75.0 AS lat, value - 100 AS lon, ts AS ping_ts FROM events"""


@query("xs4_gated_stream", f"SELECT ping_id, CASE WHEN lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 THEN 'accepted' ELSE 'quarantined' END AS outcome FROM ({_DIRTY})")
def _(t):
    rows = t.events.selectExpr("event_id AS ping_id", "double(user_id) - 75.0D AS lat", "value - 100 AS lon", "ts AS ping_ts")
    folder, out = _arrived(t, rows), workspace(t.spark, "gate")
    stream = jobs.file_stream(t.spark, folder, rows.schema, "parquet", files_per_batch=2)
    gate = jobs.gate_batches(CONTRACTS["pings"], f"{out}/good", f"{out}/bad", f"{out}/log", ingest_column="ping_ts")
    jobs.run_available(stream, f"{out}/checkpoint", per_batch=gate)
    read = lambda part, label: t.spark.read.parquet(f"{out}/{part}").select("ping_id", F.lit(label).alias("outcome"))
    return read("good", "accepted").unionByName(read("bad", "quarantined"))


@query("xs5_upserted_stream", "SELECT user_id, ts, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events) WHERE r = 1")
def _(t):
    rows = t.events.select("user_id", "ts", "value")
    folder, out = _arrived(t, rows), workspace(t.spark, "upsert")
    table = UpsertTable(t.spark, f"{out}/data", "user_id", buckets=4)
    stream = jobs.file_stream(t.spark, folder, rows.schema, "parquet", files_per_batch=2)
    jobs.run_available(stream, f"{out}/checkpoint", per_batch=jobs.upsert_batches(table, "ts"))
    return table.read()
