"""V: the data-quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import count_if, half_up, n, sql
from medalyst.checks.registry import query
from medalyst.contracts import CANCELLATIONS, CONTRACTS, DELIVERIES, ORDERS, PRICING, RIDERS, SUPPORT
from medalyst.operators import quality
from medalyst.session import workspace

AS_OF = "2002-01-01"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def _fresh(ts: str) -> str:
    return f"CAST(COALESCE(date_diff('second', MAX({ts}), TIMESTAMP '{AS_OF}') // 86400 > 2, TRUE) AS INTEGER)"


def gate_sql(entity: str, view: str, key: str, ts: str, rules: list[tuple[str, str, str, str]], freshness: str, *views: str) -> str:
    """Expected result rows of a gate run: one SELECT per check."""
    def row(check, kind, failed, severity):
        return (f"SELECT '{entity}_raw' AS table_name, '{check}' AS check_name, '{kind}' AS check_type, CAST({failed} AS BIGINT) AS failed_rows, "
                f"{n()} AS total_rows, CASE WHEN {failed} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '{severity}' AS severity FROM {view}")

    parts = [row("schema_exact_match", "schema_check", "1", "CRITICAL"), row("table_not_empty", "table_check", "CAST(COUNT(*) = 0 AS INTEGER)", "CRITICAL"),
             row(f"{key}_unique", "duplicate_check", f"(SELECT COUNT(*) FROM (SELECT {key} FROM {view} GROUP BY 1 HAVING COUNT(*) > 1))", "CRITICAL"),
             *[row(c, k, f"COUNT(*) FILTER (WHERE {cond})", s) for c, k, cond, s in rules],
             row(freshness, "freshness_check", _fresh(ts), "CRITICAL"),
             row("volume_reasonable_min_threshold", "volume_check", "CAST(COUNT(*) < 100 AS INTEGER)", "WARNING")]
    return sql(" UNION ALL ".join(parts), *views)


_LATE = "data_freshness_within_threshold"


@query("v03_rule_pack_orders", gate_sql("orders", "ow_orders", "order_id", "ingestion_ts", [
    ("order_id_not_null", "null_check", "order_id IS NULL", "CRITICAL"), ("order_value_positive", "range_check", "order_value < 0", "ERROR"),
    ("promised_after_created", "timestamp_check", "promised_ts < created_ts", "ERROR"),
    ("accepted_after_created", "timestamp_check", "accepted_ts < created_ts", "WARNING"),
    ("payment_status_domain_valid", "domain_check", "payment_status NOT IN ('Paid', 'Pending', 'Failed')", "ERROR")],
    "data_freshness_within_2_days", "ow_orders"))
def _(t):
    return quality.check_results(b.orders(t), ORDERS, as_of(), ingest_column="ingestion_ts")


@query("v03_rule_pack_deliveries", gate_sql("deliveries", "ow_deliveries", "delivery_id", "ingestion_ts", [
    ("delivery_id_not_null", "null_check", "delivery_id IS NULL", "CRITICAL"), ("pickup_after_dispatch", "timestamp_check", "pickup_ts < dispatch_ts", "ERROR"),
    ("drop_after_pickup", "timestamp_check", "drop_ts < pickup_ts", "ERROR"), ("distance_positive", "range_check", "distance_km_actual <= 0", "ERROR"),
    ("duration_reasonable", "range_check", "duration_min_actual <= 0 OR duration_min_actual > 180", "WARNING"),
    ("rating_bounds_valid", "range_check", "customer_rating NOT BETWEEN 1 AND 5 OR rider_rating NOT BETWEEN 1 AND 5", "WARNING")], _LATE, "ow_deliveries"))
def _(t):
    return quality.check_results(b.deliveries(t), DELIVERIES, as_of(), ingest_column="ingestion_ts")


@query("v03_rule_pack_cancellations", gate_sql("cancellations", "ow_cancels", "cancel_id", "ingestion_ts", [
    ("cancel_id_not_null", "null_check", "cancel_id IS NULL", "CRITICAL"), ("cancel_ts_not_null", "null_check", "cancel_ts IS NULL", "ERROR"),
    ("refund_non_negative", "range_check", "refund_amount < 0", "ERROR"), ("compensation_non_negative", "range_check", "compensation_paid < 0", "ERROR"),
    ("cancel_actor_domain_valid", "domain_check", "cancel_actor NOT IN ('Customer', 'Rider', 'System')", "ERROR"),
    ("refund_reasonable", "range_check", "refund_amount > 200", "WARNING")], _LATE, "ow_cancels"))
def _(t):
    return quality.check_results(b.cancellations(t), CANCELLATIONS, as_of(), ingest_column="ingestion_ts")


@query("v03_rule_pack_riders", gate_sql("riders", "riders_joined", "rider_id", "join_date", [
    ("rider_id_not_null", "null_check", "rider_id IS NULL", "CRITICAL"), ("rating_bounds_valid", "range_check", "rating_avg NOT BETWEEN 1 AND 5", "ERROR"),
    ("join_date_not_future", "timestamp_check", f"join_date > DATE '{AS_OF}'", "ERROR")], _LATE).replace("SELECT", """WITH riders_joined AS (SELECT s_suppkey AS rider_id,
    s_acctbal / 2000 AS rating_avg, TIMESTAMP '2001-12-20' + to_days(CAST(s_suppkey % 30 AS INTEGER)) AS join_date FROM supplier) SELECT""", 1))
def _(t):
    joined = b.riders(t).withColumn("join_date", F.expr("TIMESTAMP_NTZ '2001-12-20' + make_dt_interval(int(rider_id % 30))"))
    return quality.check_results(joined, RIDERS, as_of(), ingest_column="join_date")


@query("v03_rule_pack_pings", gate_sql("pings", "p", "ping_id", "ping_ts", [
    ("ping_id_not_null", "null_check", "ping_id IS NULL", "CRITICAL"), ("latitude_valid", "range_check", "lat NOT BETWEEN -90 AND 90", "ERROR"),
    ("longitude_valid", "range_check", "lon NOT BETWEEN -180 AND 180", "ERROR"), ("speed_reasonable", "range_check", "speed_kmh NOT BETWEEN 0 AND 120", "ERROR"),
    ("battery_range_valid", "range_check", "battery_level NOT BETWEEN 0 AND 100", "ERROR"), ("ping_ts_not_null", "null_check", "ping_ts IS NULL", "ERROR"),
    ("gps_accuracy_reasonable", "range_check", "accuracy_meters > 100", "WARNING"), ("mock_location_detected", "fraud_check", "is_mock_location_flag", "WARNING"),
    ("network_type_domain_valid", "domain_check", "network_type NOT IN ('4G', '5G', 'WiFi')", "WARNING")], _LATE)
    .replace("SELECT", """WITH p AS (SELECT event_id AS ping_id, user_id - 75.0 AS lat, value - 100 AS lon, CAST(trunc(value) AS INTEGER) AS speed_kmh,
    CAST(event_id % 110 AS INTEGER) AS battery_level, ts AS ping_ts, CAST(event_id % 130 AS INTEGER) AS accuracy_meters, event_id % 10 = 0 AS is_mock_location_flag,
    CASE event_id % 4 WHEN 0 THEN '4G' WHEN 1 THEN '5G' WHEN 2 THEN 'WiFi' ELSE '3G' END AS network_type FROM events) SELECT""", 1))
def _(t):
    pings = t.events.selectExpr(
        "event_id AS ping_id", "user_id - 75.0 AS lat", "value - 100 AS lon", "int(value) AS speed_kmh", "int(event_id % 110) AS battery_level",
        "ts AS ping_ts", "int(event_id % 130) AS accuracy_meters", "event_id % 10 = 0 AS is_mock_location_flag",
        "element_at(array('4G', '5G', 'WiFi', '3G'), int(event_id % 4) + 1) AS network_type")
    return quality.check_results(pings, CONTRACTS["pings"], as_of(), ingest_column="ping_ts")


@query("v03_rule_pack_pricing", gate_sql("pricing", "p", "pricing_event_id", "pricing_ts", [
    ("pricing_event_id_not_null", "null_check", "pricing_event_id IS NULL", "CRITICAL"),
    ("monetary_fields_positive", "range_check", "base_fare < 0 OR distance_fare < 0 OR time_fare < 0 OR service_fee < 0 OR platform_fee < 0", "ERROR"),
    ("surge_multiplier_valid", "range_check", "surge_multiplier NOT BETWEEN 1 AND 5", "ERROR"), ("final_price_positive", "range_check", "final_customer_price <= 0", "ERROR"),
    ("discount_reasonable", "range_check", "discount_amount > 100", "WARNING")], _LATE).replace("SELECT", """WITH p AS (SELECT l_orderkey AS pricing_event_id, l_shipdate AS pricing_ts,
    l_quantity - 5 AS base_fare, l_tax AS distance_fare, l_discount AS time_fare, l_tax - 0.01 AS service_fee, l_discount - 0.02 AS platform_fee,
    1 + l_discount * 50 AS surge_multiplier, l_extendedprice - 2000 AS final_customer_price, l_extendedprice * l_discount AS discount_amount FROM lineitem) SELECT""", 1))
def _(t):
    prices = t.lineitem.selectExpr(
        "l_orderkey AS pricing_event_id", "l_shipdate AS pricing_ts", "l_quantity - 5 AS base_fare", "l_tax AS distance_fare", "l_discount AS time_fare",
        "l_tax - 0.01D AS service_fee", "l_discount - 0.02D AS platform_fee", "1 + l_discount * 50 AS surge_multiplier",
        "l_extendedprice - 2000 AS final_customer_price", "l_extendedprice * l_discount AS discount_amount")
    return quality.check_results(prices, PRICING, as_of(), ingest_column="pricing_ts")


@query("v03_rule_pack_shifts", gate_sql("shifts", "live_shifts_ended", "shift_id", "actual_login_ts", [
    ("shift_id_not_null", "null_check", "shift_id IS NULL", "CRITICAL"), ("rider_id_not_null", "null_check", "rider_id IS NULL", "ERROR"),
    ("shift_time_order_valid", "timestamp_check", "shift_end_ts < shift_start_ts", "ERROR"), ("scheduled_hours_positive", "range_check", "scheduled_hours <= 0", "ERROR"),
    ("shift_status_domain_valid", "domain_check", "shift_status NOT IN ('Completed', 'Cancelled')", "ERROR"),
    ("shift_length_reasonable", "range_check", "scheduled_hours > 14", "WARNING"), ("login_logout_order_valid", "timestamp_check", "actual_logout_ts < actual_login_ts", "WARNING")], _LATE)
    .replace("SELECT", """WITH live_shifts_ended AS (SELECT event_id AS shift_id, user_id AS rider_id, ts AS shift_start_ts, ts + to_minutes(event_id % 50 - 5) AS shift_end_ts,
    value - 1 AS scheduled_hours, ts AS actual_login_ts, ts + to_minutes(event_id % 40 - 2) AS actual_logout_ts, event_type AS shift_status FROM events) SELECT""", 1))
def _(t):
    shifts = t.events.selectExpr(
        "event_id AS shift_id", "user_id AS rider_id", "ts AS shift_start_ts", "ts + make_dt_interval(0, 0, int(event_id % 50) - 5) AS shift_end_ts",
        "value - 1 AS scheduled_hours", "ts AS actual_login_ts", "ts + make_dt_interval(0, 0, int(event_id % 40) - 2) AS actual_logout_ts", "event_type AS shift_status")
    return quality.check_results(shifts, CONTRACTS["shifts"], as_of(), ingest_column="actual_login_ts")


@query("v03_rule_pack_support", gate_sql("support", "s", "ticket_id", "created_ts", [
    ("ticket_id_not_null", "null_check", "ticket_id IS NULL", "CRITICAL"), ("resolution_time_valid", "timestamp_check", "resolution_ts < created_ts", "ERROR"),
    ("csat_bounds_valid", "range_check", "csat_score NOT BETWEEN 1 AND 5", "ERROR"),
    ("resolution_status_domain_valid", "domain_check", "resolution_status NOT IN ('Refunded', 'Resolved', 'Open')", "ERROR"),
    ("priority_domain_valid", "domain_check", "priority_level NOT IN ('Low', 'Medium', 'High')", "ERROR"),
    ("agent_present", "completeness_check", "agent_id IS NULL", "WARNING"), ("compensation_reasonable", "range_check", "compensation_amount > 200", "WARNING")], _LATE)
    .replace("SELECT", """WITH s AS (SELECT event_id AS ticket_id, ts AS created_ts, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts + to_minutes(event_id % 20 - 3) END AS resolution_ts,
    CAST(event_id % 8 AS INTEGER) AS csat_score, event_type AS resolution_status, CASE event_id % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'Urgent' END AS priority_level,
    CASE WHEN event_id % 6 > 0 THEN user_id END AS agent_id, value AS compensation_amount FROM events) SELECT""", 1))
def _(t):
    tickets = t.events.selectExpr(
        "event_id AS ticket_id", "ts AS created_ts", "IF(event_id % 3 = 0, NULL, ts + make_dt_interval(0, 0, int(event_id % 20) - 3)) AS resolution_ts",
        "int(event_id % 8) AS csat_score", "event_type AS resolution_status", "element_at(array('Low', 'Medium', 'High', 'Urgent'), int(event_id % 4) + 1) AS priority_level",
        "IF(event_id % 6 > 0, user_id, NULL) AS agent_id", "value AS compensation_amount")
    return quality.check_results(tickets, SUPPORT, as_of(), ingest_column="created_ts")


@query("v01_schema_drift", f"""SELECT 'c_acctbal' AS column_name, 'unexpected' AS drift, {n('c_acctbal')} AS n_rows FROM customer
    UNION ALL SELECT 'c_mktsegment', 'unexpected', {n('c_mktsegment')} FROM customer UNION ALL SELECT 'segment', 'missing', {n()} FROM customer""")
def _(t):
    return quality.drift_report(t.customer, ["c_custkey", "c_name", "c_nationkey", "segment"])


@query("v01_type_drift_gate", f"SELECT check_name, failed_rows, total_rows, CASE WHEN failed_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT 'schema_exact_match' AS check_name, CAST(0 AS BIGINT) AS failed_rows, {n()} AS total_rows FROM orders UNION ALL SELECT 'schema_types_match', 2, {n()} FROM orders)")
def _(t):
    # every column of the contract is there, two of them with another type
    expected = {f.name: f.dataType for f in ORDERS.bronze}
    given = {"order_id": F.col("o_orderkey"), "order_value": F.col("o_totalprice"), "tax_amount": F.col("o_totalprice").cast("string"),
             "bronze_ingestion_ts": F.col("o_orderdate").cast("timestamp")}
    typed = {"order_id": "bigint", "tax_amount": "string"}
    rows = t.orders.select(*[given.get(c, F.lit(None)).cast(typed.get(c, kind)).alias(c) for c, kind in expected.items()])
    results = quality.check_results(rows, ORDERS, as_of(), types=True)
    return results.where("check_type = 'schema_check'").select("check_name", "failed_rows", "total_rows", "status")


@query("v02_table_not_empty", f"SELECT {n()} AS total_rows, COUNT(*) > 0 AS not_empty FROM events")
def _(t):
    rows = F.count(F.lit(1))
    return t.events.agg(rows.alias("total_rows"), (~quality.is_empty(rows)).alias("not_empty"))


@query("v04_key_uniqueness", f"SELECT {n()} AS duplicate_keys, CAST(SUM(c - 1) AS BIGINT) AS surplus_rows FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)")
def _(t):
    from medalyst.operators.dedupe import duplicate_keys
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]).agg(F.count(F.lit(1)).alias("duplicate_keys"), F.sum(F.col("n_rows") - 1).alias("surplus_rows"))


@query("v05_freshness_days", f"SELECT event_type, date_diff('second', MAX(ts), TIMESTAMP '2024-02-03') // 86400 AS age_days, date_diff('second', MAX(ts), TIMESTAMP '2024-02-03') // 86400 > 2 AS stale FROM events GROUP BY 1")
def _(t):
    newest, now = F.max("ts"), F.lit("2024-02-03").cast("timestamp_ntz")
    return t.events.groupBy("event_type").agg(quality.days_since(newest, now).alias("age_days"), quality.is_stale(newest, now).alias("stale"))


@query("v06_volume", f"SELECT l_suppkey, {n()} AS total_rows, COUNT(*) < 600 AS too_small FROM lineitem GROUP BY 1")
def _(t):
    # the per-source form of the volume check, with a limit inside the data's range
    return t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("total_rows"), quality.is_small(F.count(F.lit(1)), 600).alias("too_small"))


@query("v07_results_by_severity",
       sql(f"""SELECT severity, status, {n()} AS checks FROM (
    SELECT 'CRITICAL' AS severity, 'FAIL' AS status UNION ALL SELECT 'CRITICAL', CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END FROM ow_orders
    UNION ALL SELECT 'CRITICAL', CASE WHEN COUNT(DISTINCT order_id) = COUNT(*) THEN 'PASS' ELSE 'FAIL' END FROM ow_orders
    UNION ALL SELECT 'CRITICAL', CASE WHEN COUNT(*) = COUNT(order_id) THEN 'PASS' ELSE 'FAIL' END FROM ow_orders
    UNION ALL SELECT 'CRITICAL', CASE WHEN {_fresh('ingestion_ts')} = 0 THEN 'PASS' ELSE 'FAIL' END FROM ow_orders
    UNION ALL SELECT 'ERROR', CASE WHEN {count_if('order_value < 0')} = 0 THEN 'PASS' ELSE 'FAIL' END FROM ow_orders
    UNION ALL SELECT 'ERROR', CASE WHEN {count_if('promised_ts < created_ts')} = 0 THEN 'PASS' ELSE 'FAIL' END FROM ow_orders
    UNION ALL SELECT 'WARNING', CASE WHEN {count_if('accepted_ts < created_ts')} = 0 THEN 'PASS' ELSE 'FAIL' END FROM ow_orders
    UNION ALL SELECT 'ERROR', CASE WHEN {count_if("payment_status NOT IN ('Paid', 'Pending', 'Failed')")} = 0 THEN 'PASS' ELSE 'FAIL' END FROM ow_orders
    UNION ALL SELECT 'WARNING', CASE WHEN COUNT(*) >= 100 THEN 'PASS' ELSE 'FAIL' END FROM ow_orders) GROUP BY ALL""", "ow_orders"))
def _(t):
    results = quality.check_results(b.orders(t), ORDERS, as_of(), ingest_column="ingestion_ts")
    return results.groupBy("severity", "status").agg(F.count(F.lit(1)).alias("checks"))


@query("v07_result_log", sql(f"""SELECT check_name, CAST(2 AS BIGINT) AS runs, failed, TIMESTAMP '2002-01-02' AS newest_run, CASE WHEN failed = 0 THEN 'PASS' ELSE 'FAIL' END AS newest_status FROM (
    SELECT 'order_value_positive' AS check_name, {count_if('order_value < 0')} AS failed FROM ow_orders UNION ALL
    SELECT 'accepted_after_created', {count_if('accepted_ts < created_ts')} FROM ow_orders)""", "ow_orders"))
def _(t):
    path = workspace(t.spark, "log")
    orders = b.orders(t)
    for rows, day in ((orders.where("order_value < 0 OR order_value >= 1000"), "2002-01-01"), (orders, "2002-01-02")):
        quality.log_results(quality.check_results(rows, ORDERS, as_of(), ingest_column="ingestion_ts"), path, F.lit(day).cast("timestamp"))
    log = t.spark.read.parquet(path).where("check_name IN ('order_value_positive', 'accepted_after_created')")
    newest = quality.latest_results(log).select("check_name", F.col("failed_rows").alias("failed"), F.col("run_ts").cast("timestamp_ntz").alias("newest_run"), F.col("status").alias("newest_status"))
    return log.groupBy("check_name").agg(F.count(F.lit(1)).alias("runs")).join(newest, "check_name")


_BAD_DELIVERY = "NOT (distance_km_actual > 0 AND duration_min_actual > 0 AND pickup_ts >= dispatch_ts)"


@query("v08_quarantined_rows", sql(f"SELECT delivery_id, order_id, pickup_ts, dispatch_ts, FALSE AS is_valid FROM ow_deliveries WHERE {_BAD_DELIVERY}", "ow_deliveries"))
def _(t):
    flagged = quality.with_validity(b.deliveries(t), DELIVERIES)
    return quality.quarantined(flagged).select("delivery_id", "order_id", "pickup_ts", "dispatch_ts", "is_valid")


@query("v08_undecided_rows_pass", sql(f"SELECT {count_if('drop_ts < pickup_ts')} AS bad, {count_if('drop_ts >= pickup_ts')} AS good, {count_if('drop_ts IS NULL')} AS undecided FROM ow_deliveries", "ow_deliveries"))
def _(t):
    flagged = b.deliveries(t).withColumn("is_valid", F.col("drop_ts") >= F.col("pickup_ts"))
    let_through = quality.accepted(flagged, "delivery_id", undecided_is_bad=False, by_key=False)
    rows = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return t.spark.range(1).select(rows(quality.quarantined(flagged, undecided_is_bad=False)).alias("bad"), rows(let_through.where("drop_ts IS NOT NULL")).alias("good"),
                                   rows(let_through.where("drop_ts IS NULL")).alias("undecided"))


@query("v09_batch_window", """SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'""")
def _(t):
    return quality.batch_slice(t.events.select("event_id", "ts"), "20240105060000", "20240120000000", column="ts")


@query("v10_row_health", sql(f"""SELECT {n()} AS total_records, {count_if("rider_id IS NOT NULL AND delivery_status IN ('success', 'cancel')")} AS valid_records,
    {half_up(count_if("rider_id IS NOT NULL AND delivery_status IN ('success', 'cancel')") + ' * 100.0::DOUBLE / COUNT(*)')} AS overall_health_pct FROM fact_delivery""", "fact_delivery"))
def _(t):
    from medalyst.plans.delivery import delivery_performance
    facts = delivery_performance(b.orders(t), b.deliveries(t), b.cancellations(t))
    return quality.health_score(facts, ["order_id", "rider_id", "city"], "delivery_status", ["success", "cancel"])
