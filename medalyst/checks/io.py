"""S and K: scans, sinks and table maintenance, each written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks.oracle import money, n
from medalyst.checks.registry import query
from medalyst.operators.quality import batch_slice
from medalyst.session import durable, workspace
from medalyst.sources import readers, writers
from medalyst.sources.ingest import Bronze
from medalyst.sources.layout import clustered, file_ranges, files_touched
from medalyst.sources.upsert import UpsertTable


@query("s01_csv_with_schema", "SELECT * FROM supplier")
def _(t):
    path = workspace(t.spark, "csv")
    writers.export_csv(t.supplier, path)
    return readers.read_csv(t.spark, path, t.supplier.schema)


@query("s02_csv_inferred", "SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def _(t):
    path = workspace(t.spark, "csv")
    writers.export_csv(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"), path)
    return readers.read_csv(t.spark, path)


@query("s04_table_scan", "SELECT * FROM nation")
def _(t):
    return t.nation


def _land(rows, folder, by="event_type"):
    """``rows`` as CSV files that arrive in ``folder``."""
    rows.write.mode("append").option("header", True).partitionBy(by).csv(folder)


@query("s01_malformed_lines", "SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'rejected' ELSE 'accepted' END AS outcome, CASE WHEN event_id % 50 <> 0 THEN value END AS value FROM events")
def _(t):
    folder, kept = workspace(t.spark, "landing"), t.events.select("event_id", "value")
    _land(t.events.select("event_id", F.when(F.col("event_id") % 50 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value"), "event_type"), folder)
    bronze = Bronze(t.spark, "events", folder, kept.schema, workspace(t.spark, "bronze"))
    bronze.run()
    lines = bronze.rejected().where(F.col("line").endswith(",n/a")).select(
        F.split("line", ",")[0].cast("bigint").alias("event_id"), F.lit("rejected").alias("outcome"), F.lit(None).cast("double").alias("value"))
    return bronze.read().select("event_id", F.lit("accepted").alias("outcome"), "value").unionByName(lines)


@query("s05_new_files_only", "SELECT event_id, value FROM events WHERE event_type NOT IN ('view', 'click')")
def _(t):
    folder, rows = workspace(t.spark, "landing"), t.events.select("event_id", "value", "event_type")
    bronze = Bronze(t.spark, "events", folder, rows.drop("event_type").schema, workspace(t.spark, "bronze"))
    _land(rows.where("event_type IN ('view', 'click')"), folder)
    bronze.run()
    _land(rows.where("event_type NOT IN ('view', 'click')"), folder)
    fresh = durable(bronze.waiting().select(F.col("file_path").alias("source_file")))
    bronze.run()
    return bronze.read().join(fresh, "source_file", "left_semi").select("event_id", "value")


@query("s06_counts_as_rows", f"SELECT 'orders' AS table_name, {n()} AS n_rows, CAST(NULL AS VARCHAR) AS note FROM orders UNION ALL SELECT 'lineitem', {n()}, NULL FROM lineitem")
def _(t):
    from medalyst.contracts import struct
    from pyspark.sql import types as T
    rows = [(name, getattr(t, name).count(), None) for name in ("orders", "lineitem")]
    schema = T.StructType([*struct("table_name string").fields, T.StructField("n_rows", T.LongType()), *struct("note string").fields])
    return readers.literal_rows(t.spark, rows, schema)


@query("s07_time_slice", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-07-01'")
def _(t):
    return batch_slice(t.orders, "19960101000000", "19960701000000", column="o_orderdate").select("o_orderkey")


@query("s07_bronze_by_load_date", "SELECT event_id, CAST(ts AS DATE) AS bronze_date FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20'")
def _(t):
    folder, rows = workspace(t.spark, "landing"), t.events.select("event_id", "ts", "event_type")
    _land(rows, folder)
    bronze = Bronze(t.spark, "events", folder, rows.drop("event_type").schema, workspace(t.spark, "bronze"))
    bronze.run(loaded_at=F.col("ts"))
    return batch_slice(bronze.read(), "20240105060000", "20240120000000").select("event_id", "bronze_date")


@query("s08_single_column_metrics", f"SELECT {n()} AS n_rows, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship FROM lineitem")
def _(t):
    return t.lineitem.select("l_shipdate").agg(F.count(F.lit(1)).alias("n_rows"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@query("k01_append", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    path = workspace(t.spark, "table")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    writers.append(rows.where("o_totalprice < 250000"), path)
    writers.append(rows.where("o_totalprice >= 250000"), path)
    return t.spark.read.parquet(path)


@query("k02_overwrite", "SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def _(t):
    path = workspace(t.spark, "table")
    writers.replace(t.customer.select("c_custkey"), path)
    writers.replace(t.customer.where("c_acctbal > 0").select("c_custkey"), path)
    return t.spark.read.parquet(path)


@query("k03_overwrite_with_new_schema", "SELECT c_custkey, CAST(c_acctbal AS INTEGER) AS balance FROM customer WHERE c_acctbal = FLOOR(c_acctbal) UNION ALL SELECT c_custkey, CAST(trunc(c_acctbal) AS INTEGER) FROM customer WHERE c_acctbal <> FLOOR(c_acctbal)")
def _(t):
    path = workspace(t.spark, "table")
    writers.replace(t.customer.select("c_custkey", "c_name"), path)
    writers.replace(t.customer.select("c_custkey", F.col("c_acctbal").cast("int").alias("balance")), path)
    return t.spark.read.parquet(path)


@query("k04_date_overwrite", "SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN value * 2 ELSE value END AS value FROM events")
def _(t):
    path = workspace(t.spark, "table")
    rows = t.events.select("event_id", F.to_date("ts").alias("day"), "value")
    writers.replace_dates(rows, path, "day")
    writers.replace_dates(rows.where("day = DATE '2024-01-10'").withColumn("value", F.col("value") * 2), path, "day")
    return t.spark.read.parquet(path).select("event_id", "day", "value")


@query("k05_keyed_upsert", "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT'")
def _(t):
    table = UpsertTable(t.spark, workspace(t.spark, "upsert"), "o_orderkey", buckets=8)
    table.merge(t.orders.where("o_orderstatus <> 'P'").selectExpr("o_orderkey", "o_totalprice AS price"))
    changed = t.orders.where("o_orderpriority = '1-URGENT'").selectExpr("o_orderkey", "o_totalprice + 1 AS price")
    table.merge(changed)
    table.merge(changed)                  # the same batch again changes nothing
    return table.read()


@query("k05_upsert_with_new_column", "SELECT o_orderkey, o_totalprice AS price, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority END AS priority FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT'")
def _(t):
    table = UpsertTable(t.spark, workspace(t.spark, "upsert"), "o_orderkey", buckets=8)
    table.merge(t.orders.where("o_orderstatus <> 'P'").selectExpr("o_orderkey", "o_totalprice AS price"))
    table.merge(t.orders.where("o_orderpriority = '1-URGENT'").selectExpr("o_orderkey", "o_totalprice AS price", "o_orderpriority AS priority"), widen=True)
    return table.read()


@query("k05_upsert_by_date", """SELECT event_id, ts, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' AND event_id % 2 = 0 THEN value * 2 ELSE value END AS value, CAST(1 AS BIGINT) AS dates_touched FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-11'""")
def _(t):
    rows = t.events.select("event_id", "ts", "value")
    table = UpsertTable(t.spark, workspace(t.spark, "upsert"), "event_id", buckets=1, date="ts")
    table.merge(rows)
    touched = table.merge(rows.where("to_date(ts) = DATE '2024-01-10' AND event_id % 2 = 0").withColumn("value", F.col("value") * 2))
    return table.read("2024-01-09", "2024-01-11").withColumn("dates_touched", F.lit(len(touched)).cast("bigint"))


@query("k06_clustered_write", f"SELECT l_returnflag, {n()} AS n_rows, {money('l_extendedprice')} AS total FROM lineitem GROUP BY 1")
def _(t):
    path = workspace(t.spark, "clustered")
    writers.replace(clustered(t.lineitem, ["l_suppkey", "l_shipdate"], files=8), path)
    from medalyst.functions.columns import exact_sum
    return t.spark.read.parquet(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), exact_sum("l_extendedprice").alias("total"))


@query("k06_files_touched", f"SELECT column_name, {n()} AS n_rows, TRUE AS below_share FROM lineitem, (VALUES ('l_suppkey'), ('l_shipdate')) c(column_name) GROUP BY 1")
def _(t):
    path, cols = workspace(t.spark, "clustered"), ["l_suppkey", "l_shipdate"]
    writers.replace(clustered(t.lineitem, cols, files=16), path)
    stored = t.spark.read.parquet(path)
    # one sixteenth of the values of either column; a table in any other order would have to read all files for one of them
    low, high = (t.lineitem.agg(F.struct(*[f(c).alias(c) for c in cols])).scalar() for f in (F.min, F.max))
    wanted = {"l_suppkey": (low["l_suppkey"], low["l_suppkey"] + (high["l_suppkey"] - low["l_suppkey"]) / 16),
              "l_shipdate": (low["l_shipdate"], F.timestamp_add("SECOND", F.floor(F.timestamp_diff("SECOND", low["l_shipdate"], high["l_shipdate"]) / 16).cast("int"), low["l_shipdate"]))}
    touched = files_touched(file_ranges(stored, cols), wanted)
    return touched.select("column_name", "n_rows", (F.col("files_read") <= 0.5 * F.col("files")).alias("below_share"))


@query("k07_created_when_missing", f"SELECT {n()} AS n_rows, TRUE AS created_first, FALSE AS created_again FROM part")
def _(t):
    path = workspace(t.spark, "table")
    first = writers.create_if_missing(t.spark, path, t.part.schema)
    writers.append(t.part, path)
    again = writers.create_if_missing(t.spark, path, t.part.schema)
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).withColumns({"created_first": F.lit(first), "created_again": F.lit(again)})


@query("k08_required_tables", f"SELECT {n()} AS n_rows, 'medalyst_missing_table' AS missing FROM orders")
def _(t):
    t.orders.createOrReplaceTempView("medalyst_orders")
    try:
        readers.require_tables(t.spark, ["medalyst_orders", "medalyst_missing_table"])
        missing = ""
    except LookupError as e:
        missing = str(e).split(": ")[1]
    return t.spark.table("medalyst_orders").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("missing", F.lit(missing))


@query("k09_ingest_with_tracker", f"""SELECT (SELECT {n()} FROM events) AS n_rows, (SELECT CAST(COUNT(DISTINCT event_type) AS BIGINT) FROM events) AS files_logged, {n()} AS rows_logged,
    CAST(1 AS BIGINT) AS failures_logged, TRUE AS cause_kept, 'FAILED SUCCESS NOTHING_NEW' AS outcomes FROM events""")
def _(t):
    folder, rows = workspace(t.spark, "landing"), t.events.select("event_id", "user_id", "value", "event_type")
    _land(rows.repartition("event_type"), folder)
    bronze = Bronze(t.spark, "events", folder, rows.drop("event_type").schema, workspace(t.spark, "bronze"))
    outcomes = [bronze.run(loaded_at=F.raise_error(F.lit("unreadable batch"))), bronze.run(), bronze.run()]
    ok = F.col("status") == "SUCCESS"
    return bronze.tracker().agg(
        F.count_if(ok).alias("files_logged"), F.sum(F.when(ok, F.col("n_rows"))).alias("rows_logged"), F.count_if(~ok).alias("failures_logged"),
        F.max(F.col("cause").contains("unreadable batch")).alias("cause_kept")).select(
        bronze.read().agg(F.count(F.lit(1))).scalar().alias("n_rows"), "*", F.lit(" ".join(outcomes)).alias("outcomes"))


@query("k10_csv_export", "SELECT p_partkey, p_name, p_retailprice FROM part")
def _(t):
    path = workspace(t.spark, "export")
    rows = t.part.select("p_partkey", "p_name", "p_retailprice")
    writers.export_csv(rows, path)
    return t.spark.read.schema(rows.schema).option("header", True).csv(path)


@query("k11_audit_columns", "SELECT o_orderkey, TIMESTAMP '2002-01-01' AS silver_ingestion_ts, 'orders.parquet' AS record_source FROM orders")
def _(t):
    as_of = F.lit("2002-01-01").cast("timestamp_ntz")
    named = t.orders.select("o_orderkey", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
    return writers.stamped(named, "silver", as_of, F.col("file")).drop("file")
