"""The other silver entities from untidy bronze rows, and the load into a clustered table.

The bronze columns are written once, in SQL that Spark and the oracle share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import sql
from medalyst.checks.registry import Tables, query
from medalyst.contracts import (
    CANCELLATIONS,
    CLUSTERING,
    ORDERS,
    PINGS,
    PRICING,
    RIDERS,
    SHIFTS,
    SUPPORT,
    Contract,
)
from medalyst.operators.quality import quarantined, with_validity
from medalyst.plans.entities import load_silver, to_silver
from medalyst.session import workspace
from medalyst.sources import writers
from medalyst.sources.layout import clustered
from medalyst.sources.upsert import UpsertTable

AS_OF = "2002-01-01"

RIDER_ROWS = [
    "s_suppkey AS rider_id", "concat('  ', upper(s_name), ' ') AS rider_name", "concat(lower(n_name), ' ') AS city",
    "CASE s_suppkey % 3 WHEN 0 THEN ' Scooter' WHEN 1 THEN 'BIKE ' ELSE 'Car' END AS vehicle_type",
    "CASE WHEN s_suppkey % 2 = 0 THEN ' Active' ELSE 'INACTIVE' END AS status", "s_acctbal / 2000 AS rating_avg",
    "CAST('2001-06-01 08:00:00' AS TIMESTAMP) + s_suppkey * INTERVAL '3' DAY AS join_date",
    "CAST('2001-01-01 00:00:00' AS TIMESTAMP) AS ingestion_ts"]
SHIFT_ROWS = [
    "event_id AS shift_id", "user_id AS rider_id", "concat(' ', lower(n_name)) AS city", "ts AS shift_start_ts",
    "CASE WHEN value < 20 THEN ts - INTERVAL '1' HOUR ELSE ts + INTERVAL '8' HOUR END AS shift_end_ts", "value / 60 - 0.1 AS scheduled_hours",
    "CASE WHEN event_id % 2 = 0 THEN ' completed' ELSE 'CANCELLED ' END AS shift_status", "'morning ' AS shift_type", "ts AS ingestion_ts"]
CANCEL_ROWS = [
    "o_orderkey AS cancel_id", "o_orderkey AS order_id", "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS cancel_ts",
    "' Before Pickup' AS cancel_stage", "CASE o_orderkey % 3 WHEN 0 THEN 'customer ' WHEN 1 THEN 'RIDER' ELSE ' System' END AS cancel_actor",
    "concat(lower(o_orderpriority), ' ') AS cancel_reason_code", "c_acctbal / 50 AS refund_amount",
    "CAST(o_custkey % 5 AS DOUBLE) - 1 AS compensation_paid", "o_orderdate AS ingestion_ts"]
PING_ROWS = [
    "event_id AS ping_id", "user_id AS rider_id", "value - 20 AS lat", "value * 2 - 60 AS lon",
    "CASE WHEN user_id % 7 = 0 THEN 'n/a' ELSE CAST(user_id % 90 AS STRING) END AS speed_kmh", "' wifi' AS network_type", "'GPS ' AS gps_provider",
    "CASE WHEN event_id % 13 <> 0 THEN ts END AS ping_ts", "ts AS ingestion_ts"]
PRICE_ROWS = [
    "o_orderkey AS pricing_event_id", "o_orderkey AS order_id", "o_orderdate AS pricing_ts", "CAST(5 AS DOUBLE) AS base_fare",
    "CAST(3 + o_orderkey % 4 AS DOUBLE) / 4 AS surge_multiplier", "o_totalprice - 20000 AS final_customer_price",
    "concat('pr-', CAST(o_custkey % 7 AS STRING), ' ') AS promo_code_id", "CASE WHEN o_custkey % 2 = 0 THEN 'seasonal ' END AS promo_type",
    "o_orderdate AS ingestion_ts"]
TICKET_ROWS = [
    "event_id AS ticket_id", "user_id AS customer_id", "ts AS created_ts", "'refund ' AS issue_category", "' LATE' AS issue_subcategory",
    "' low' AS priority_level", "'OPEN' AS resolution_status",
    "CASE WHEN value < 10 THEN ts - INTERVAL '1' HOUR WHEN value < 60 THEN ts + INTERVAL '2' HOUR END AS resolution_ts", "value AS compensation_amount",
    "CAST(1 + user_id % 5 AS INT) AS csat_score", "ts AS ingestion_ts"]


def title(name: str) -> str:
    return f"upper(substr(trim({name}), 1, 1)) || lower(substr(trim({name}), 2))"


def oracle(rows: list[str], source: str, valid: str, **changed: str) -> str:
    """The rows that are valid, with the columns ``changed`` by casing or type."""
    replaced = ", ".join(f"{expr} AS {name}" for name, expr in changed.items())
    return f"SELECT * EXCLUDE (ingestion_ts) REPLACE ({replaced}) FROM (SELECT {', '.join(rows)} FROM {source}) WHERE {valid}"


def silver(bronze: DataFrame, contract: Contract) -> DataFrame:
    bad = quarantined(with_validity(bronze, contract, F.lit(AS_OF).cast("date"))).select(contract.key)
    return to_silver(bronze, contract, bad).drop("silver_ingestion_ts", "record_source")


def _events(t: Tables, kind: str) -> DataFrame:
    return t.events.where(F.col("event_type") == kind)


@query("g01_silver_riders", oracle(
    RIDER_ROWS, "supplier JOIN nation ON s_nationkey = n_nationkey", f"rating_avg BETWEEN 1 AND 5 AND join_date <= DATE '{AS_OF}'", rider_name=title("rider_name"),
    city="upper(trim(city))", vehicle_type="lower(trim(vehicle_type))", status="lower(trim(status))", join_date="CAST(join_date AS DATE)"))
def _(t):
    return silver(t.supplier.join(t.nation, F.expr("s_nationkey = n_nationkey")).selectExpr(*RIDER_ROWS), RIDERS)


@query("g01_silver_shifts", oracle(
    SHIFT_ROWS, "events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE event_type = 'signup'",
    "scheduled_hours > 0 AND shift_end_ts >= shift_start_ts", city="upper(trim(city))", shift_status=title("shift_status"), shift_type=title("shift_type")))
def _(t):
    joined = _events(t, "signup").join(t.customer, F.expr("user_id = c_custkey")).join(t.nation, F.expr("c_nationkey = n_nationkey"))
    return silver(joined.selectExpr(*SHIFT_ROWS), SHIFTS)


@query("g01_silver_cancellations", oracle(
    CANCEL_ROWS, "orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'", "cancel_ts IS NOT NULL AND refund_amount >= 0 AND compensation_paid >= 0",
    cancel_stage="lower(trim(cancel_stage))", cancel_actor=title("cancel_actor"), cancel_reason_code="upper(trim(cancel_reason_code))"))
def _(t):
    return silver(t.orders.where("o_orderstatus = 'P'").join(t.customer, F.expr("o_custkey = c_custkey")).selectExpr(*CANCEL_ROWS), CANCELLATIONS)


@query("g01_silver_pings", oracle(
    PING_ROWS, "events WHERE event_type = 'view'", "ping_ts IS NOT NULL AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180",
    speed_kmh="TRY_CAST(speed_kmh AS INTEGER)", network_type="upper(trim(network_type))", gps_provider="lower(trim(gps_provider))"))
def _(t):
    return silver(_events(t, "view").selectExpr(*PING_ROWS), PINGS)


@query("g01_silver_pricing", oracle(
    PRICE_ROWS, "orders", "final_customer_price > 0 AND surge_multiplier >= 1", promo_code_id="upper(trim(promo_code_id))", promo_type=title("promo_type")))
def _(t):
    return silver(t.orders.selectExpr(*PRICE_ROWS), PRICING)


@query("g01_silver_support", oracle(
    TICKET_ROWS, "events WHERE event_type = 'error'", "created_ts IS NOT NULL AND (resolution_ts IS NULL OR resolution_ts >= created_ts)",
    issue_category=title("issue_category"), issue_subcategory=title("issue_subcategory"), priority_level="upper(trim(priority_level))",
    resolution_status=title("resolution_status")))
def _(t):
    return silver(_events(t, "error").selectExpr(*TICKET_ROWS), SUPPORT)


@query("g01_silver_orders_loaded", sql("""
    SELECT order_id, UPPER(TRIM(city)) AS city, order_status, order_value, ingestion_ts AS version_ts
    FROM ow_orders WHERE order_value >= 0 AND promised_ts >= created_ts""", "ow_orders"))
def _(t):
    """Gate, silver form, upsert and clustered write; a late batch of older versions changes nothing."""
    bronze = b.orders(t)
    bad = quarantined(with_validity(bronze, ORDERS, F.lit(AS_OF).cast("date"))).select("order_id")
    table = UpsertTable(t.spark, workspace(t.spark, "silver"), "order_id", buckets=8)
    load_silver(table, bronze, ORDERS, quarantine=bad)
    late = bronze.withColumns({"ingestion_ts": F.expr("ingestion_ts - INTERVAL 1 DAY"), "order_value": F.lit(0.5)})
    load_silver(table, late, ORDERS, quarantine=bad)
    path = workspace(t.spark, "clustered")
    held = table.read()
    writers.replace(clustered(held, [c for c in CLUSTERING["orders"] if c in held.columns], files=4), path)
    return t.spark.read.parquet(path).select("order_id", "city", "order_status", "order_value", "version_ts")
