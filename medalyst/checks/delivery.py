"""G: silver entities, facts, gold tables and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import count_if, half_up, money, money_avg, n, sql, total
from medalyst.checks.registry import query
from medalyst.contracts import DELIVERIES, ORDERS
from medalyst.functions.columns import tidy
from medalyst.operators.quality import health_score, quarantined, with_validity
from medalyst.plans import delivery as d
from medalyst.plans.entities import to_silver

LOADED = "DATE '2002-01-01'"


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def gold_orders(t):
    return d.order_facts(b.orders(t), b.pricing(t), b.cancellations(t)).drop("gold_ingestion_ts")


def gold_deliveries(t):
    return d.delivery_facts(b.deliveries(t), b.orders(t), b.riders(t)).drop("gold_ingestion_ts")


@query("g01_silver_orders", sql("""
    SELECT order_id, customer_id, UPPER(TRIM(city)) AS city, delivery_zone, created_ts, accepted_ts, promised_ts, estimated_distance_km,
      estimated_duration_min, order_value, payment_status, order_status FROM ow_orders WHERE order_value >= 0 AND promised_ts >= created_ts""",
                                "ow_orders"))
def _(t):
    bronze = b.orders(t)
    flagged = with_validity(bronze, ORDERS, F.lit("2002-01-01").cast("date"))
    bad = quarantined(flagged).select("order_id")
    return to_silver(bronze, ORDERS, bad).drop("silver_ingestion_ts", "record_source")


@query("g01_silver_deliveries", sql("""
    SELECT delivery_id, order_id, rider_id, dispatch_ts, pickup_ts, drop_ts, delivery_status, distance_km_actual, duration_min_actual,
      customer_rating, rider_rating FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY delivery_id ORDER BY ingestion_ts DESC, tie_a DESC, tie_b DESC, tie_c DESC) AS r
        FROM ow_deliveries WHERE delivery_id NOT IN (SELECT delivery_id FROM ow_deliveries WHERE NOT (distance_km_actual > 0
          AND duration_min_actual > 0 AND pickup_ts >= dispatch_ts))) WHERE r = 1""", "ow_deliveries"))
def _(t):
    bronze = b.deliveries(t)
    bad = quarantined(with_validity(bronze, DELIVERIES))
    return to_silver(bronze, DELIVERIES, bad, tiebreak=["tie_a", "tie_b", "tie_c"]).drop("silver_ingestion_ts", "record_source")


@query("g02_fact_delivery_performance", sql(f"""
    SELECT * REPLACE ({half_up('distance_variance_km', 6)} AS distance_variance_km, {half_up('actual_total_time_min', 6)} AS actual_total_time_min)
    FROM fact_delivery""", "fact_delivery"))
def _(t):
    facts = d.delivery_performance(b.orders(t), b.deliveries(t), b.cancellations(t)).drop("fact_load_timestamp")
    return rounded(facts, "distance_variance_km", "actual_total_time_min")


@query("g03_fact_financials", sql(f"""
    SELECT o.order_id, o.city, o.created_ts, o.order_value, p.base_fare, p.surge_multiplier, p.service_fee, p.discount_amount,
      COALESCE(s.r, 0.0) AS total_refunded_amount,
      {half_up('(o.order_value + p.service_fee) - (p.discount_amount + COALESCE(s.r, 0))', 4)} AS net_revenue,
      {half_up('(o.order_value - COALESCE(s.r, 0)) * 100 / NULLIF(o.order_value, 0)', 2)} AS order_margin_percentage
    FROM ow_orders o JOIN ow_pricing p USING (order_id) LEFT JOIN (
      SELECT order_id, {money('compensation_amount', 4)} AS r FROM ow_support GROUP BY 1) s USING (order_id)""",
                                  "ow_orders", "ow_pricing", "ow_support"))
def _(t):
    return rounded(d.financials(b.orders(t), b.pricing(t), b.support(t)).drop("fact_load_timestamp"), "net_revenue", digits=4)


_PRODUCTIVITY = """
    SELECT s.shift_id, s.rider_id, r.city, CASE s.rider_id % 3 WHEN 0 THEN 'scooter' WHEN 1 THEN 'bike' ELSE 'car' END AS vehicle_type,
      s.shift_start_ts, s.actual_login_ts, s.actual_logout_ts, s.scheduled_hours,
      {hours} AS actual_hours_worked, CAST(s.late_start_flag AS INTEGER) AS is_late_start_flag,
      CAST(s.overtime_flag AS INTEGER) AS is_overtime_flag, CAST(COALESCE(p.n, 0) > 0 AS INTEGER) AS has_gps_activity_flag,
      p.top AS max_recorded_speed_kmh
    FROM live_shifts s JOIN ew_cities r ON s.rider_id = r.user_id LEFT JOIN (
      SELECT {grain}, COUNT(ping_id) AS n, MAX(speed_kmh) AS top FROM live_pings GROUP BY ALL) p ON p.rider_id = s.rider_id"""
_HOURS = half_up("date_diff('second', s.actual_login_ts, s.actual_logout_ts) / 3600.0::DOUBLE", 6)


@query("g04_fact_rider_productivity", sql(_PRODUCTIVITY.format(hours=_HOURS, grain="rider_id"), "live_shifts", "ew_cities", "live_pings"))
def _(t):
    facts = d.rider_productivity(b.live_riders(t), b.live_shifts(t), b.live_pings(t)).drop("fact_load_timestamp")
    return rounded(facts, "actual_hours_worked")


@query("j08_fan_out_join", sql(_PRODUCTIVITY.format(hours=_HOURS, grain="rider_id, delivery_id"), "live_shifts", "ew_cities", "live_pings"))
def _(t):
    facts = d.rider_productivity(b.live_riders(t), b.live_shifts(t), b.live_pings(t), per_delivery=True)
    return rounded(facts.drop("fact_load_timestamp"), "actual_hours_worked")


@query("g05_fact_customer_experience", sql("""
    SELECT o.order_id, o.customer_id, o.city, o.created_ts, d.customer_rating, d.delivery_status, s.ticket_id, s.issue_category,
      s.compensation_amount, s.csat_score, CAST(s.ticket_id IS NOT NULL AS INTEGER) AS has_support_ticket_flag,
      CASE WHEN d.customer_rating <= 2 OR s.ticket_id IS NOT NULL OR o.order_status = 'cancel' THEN 1 ELSE 0 END AS is_friction_event_flag,
      'SILVER_JOIN' AS transformation_source
    FROM ow_orders o LEFT JOIN ow_deliveries d USING (order_id) LEFT JOIN ow_support s USING (order_id)""",
                                           "ow_orders", "ow_deliveries", "ow_support"))
def _(t):
    return d.customer_experience(b.orders(t), b.deliveries(t), b.support(t)).drop("fact_load_timestamp")


@query("g06_gold_order_facts", sql(f"SELECT * REPLACE ({half_up('net_revenue', 4)} AS net_revenue) FROM gold_orders", "gold_orders"))
def _(t):
    return rounded(gold_orders(t), "net_revenue", digits=4)


@query("g07_gold_delivery_facts", sql(f"""
    SELECT * REPLACE ({half_up('total_delivery_time_min', 6)} AS total_delivery_time_min, {half_up('delay_minutes', 6)} AS delay_minutes)
    FROM gold_deliveries""", "gold_deliveries"))
def _(t):
    return rounded(gold_deliveries(t), "total_delivery_time_min", "delay_minutes")


@query("g08_gold_rider_daily_summary", sql(f"""
    SELECT rider_id, delivery_date, scheduled_hours, {half_up('actual_online_hours', 6)} AS actual_online_hours, total_completed_deliveries,
      total_km_driven, {half_up('deliveries_per_hour', 6)} AS deliveries_per_hour, {half_up('on_time_rate', 6)} AS on_time_rate
    FROM rider_daily""", "rider_daily"))
def _(t):
    daily = d.rider_daily_summary(b.live_shifts(t), b.live_deliveries(t)).drop("gold_ingestion_ts")
    return rounded(daily, "actual_online_hours", "deliveries_per_hour", "on_time_rate")


@query("g09_gold_city_operations", sql(f"""
    SELECT city, order_date, order_hour, o.n AS demand_order_count, s.n AS supply_rider_count, {half_up('o.n / s.n::DOUBLE')} AS orders_per_rider_ratio,
      CASE WHEN o.n / s.n::DOUBLE > 1.5 THEN 'UNDER_SUPPLIED' WHEN o.n / s.n::DOUBLE < 1 THEN 'OVER_SUPPLIED' ELSE 'BALANCED' END AS market_status
    FROM (SELECT city, order_date, order_hour, {n()} AS n FROM live_orders GROUP BY ALL) o JOIN (
      SELECT city, CAST(actual_login_ts AS DATE) AS order_date, CAST(hour(actual_login_ts) AS INTEGER) AS order_hour,
        {n('DISTINCT rider_id')} AS n FROM live_shifts GROUP BY ALL) s USING (city, order_date, order_hour)""", "live_orders", "live_shifts"))
def _(t):
    return d.city_operations(b.live_orders(t), b.live_shifts(t), under=1.5).drop("gold_ingestion_ts")


@query("g10_gold_customer_experience", sql(f"""
    SELECT city, report_date, {half_up('s.csat')} AS avg_csat, s.n AS total_support_tickets,
      {half_up('s.n * 100.0::DOUBLE / o.n')} AS contact_rate_pct, {half_up('s.refunds * 100.0::DOUBLE / o.n')} AS refund_rate_pct
    FROM (SELECT o.city, CAST(s.created_ts AS DATE) AS report_date, {n()} AS n, AVG(csat_score) AS csat,
        {count_if("issue_category = 'refund'")} AS refunds
      FROM live_support s LEFT JOIN (SELECT order_id, user_id, city FROM tickets_city) o ON s.ticket_id = o.order_id GROUP BY ALL) s
    JOIN (SELECT city, order_date AS report_date, {n()} AS n FROM live_orders GROUP BY ALL) o USING (city, report_date)""",
                                           "live_support", "live_orders", tickets_city="""
    SELECT event_id AS order_id, user_id, city FROM events JOIN ew_cities USING (user_id)"""))
def _(t):
    # every event can carry a ticket here, so the order side of the ticket join is all events
    cities = b._cities(t)
    placed = b.live_orders(t).select("order_id", "city", "order_date")
    others = t.events.where("event_type <> 'purchase'").join(cities, "user_id").selectExpr(
        "event_id AS order_id", "city", "CAST(NULL AS DATE) AS order_date")
    mart = placed.unionByName(others)
    tickets = b.live_support(t).withColumn("order_id", F.col("ticket_id"))
    return d.customer_experience_kpis(mart, tickets).drop("gold_ingestion_ts")


@query("g11_delivery_kpis", sql(f"""
    SELECT city, report_date, o.n AS total_orders_placed, o.ok AS total_completed_orders, o.gone AS total_cancelled_orders,
      o.gone / o.n::DOUBLE AS cancellation_rate, {half_up('o.rev')} AS net_revenue, {half_up('o.basket')} AS avg_basket_value,
      {half_up('d.otd', 4)} AS otd_pct, {half_up('d.mins')} AS avg_delivery_min
    FROM (SELECT city, order_date AS report_date, {n()} AS n, {total('is_success_flag')} AS ok, {total('is_cancelled_flag')} AS gone,
        {money('net_revenue', 4)} AS rev, {money_avg('order_value')} AS basket FROM gold_orders GROUP BY ALL) o
    JOIN (SELECT city, delivery_date AS report_date, {money_avg('total_delivery_time_min', 6)} AS mins,
        SUM(is_on_time_flag) / COUNT(delivery_id)::DOUBLE AS otd FROM gold_deliveries GROUP BY ALL) d USING (city, report_date)""",
                                "gold_orders", "gold_deliveries"))
def _(t):
    return d.delivery_kpis(gold_orders(t), gold_deliveries(t)).drop("gold_ingestion_ts")


@query("g12_gold_rider_performance", sql(f"""
    SELECT rider_id, CASE WHEN n > 20 THEN 'ELITE' WHEN n > 5 THEN 'PRO' ELSE 'ROOKIE' END AS rider_tier, days AS days_active,
      n AS total_lifetime_deliveries, {half_up('dph')} AS avg_dph, {half_up('otd', 4)} AS lifetime_otd_pct,
      {half_up('otd * 0.7 + dph * 0.3')} AS reliability_score
    FROM (SELECT rider_id, {n('delivery_date')} AS days, {total('total_completed_deliveries')} AS n, {money_avg('deliveries_per_hour', 9)} AS dph,
      {money_avg('on_time_rate', 9)} AS otd FROM rider_daily GROUP BY 1)""", "rider_daily"))
def _(t):
    daily = d.rider_daily_summary(b.live_shifts(t), b.live_deliveries(t))
    return d.rider_performance(daily, elite=20, pro=5).drop("gold_ingestion_ts")


def _loaded(t):
    facts = d.delivery_performance(b.orders(t), b.deliveries(t), b.cancellations(t))
    return facts.withColumn("fact_load_timestamp", F.coalesce("drop_ts", "promised_ts"))


@query("g13_ingestion_latency", sql(f"""
    SELECT city, {half_up('AVG(s)', 4)} AS avg_delay_sec, MAX(s) AS max_spike_sec, {n()} AS sample_size, quantile_disc(s, 0.95) AS p95_delay_sec
    FROM (SELECT city, date_diff('second', created_ts, COALESCE(drop_ts, promised_ts)) AS s FROM fact_delivery) GROUP BY city""", "fact_delivery"))
def _(t):
    return rounded(d.ingestion_latency(_loaded(t)), "avg_delay_sec", digits=4)


@query("g14_load_throughput", sql(f"""
    SELECT *, date_diff('second', start_time, end_time) AS processing_duration_sec,
      {half_up("total_rows_processed / NULLIF(date_diff('second', start_time, end_time), 0)::DOUBLE", 9)} AS rows_per_second
    FROM (SELECT {n()} AS total_rows_processed, MIN(COALESCE(drop_ts, promised_ts)) AS start_time,
      MAX(COALESCE(drop_ts, promised_ts)) AS end_time FROM fact_delivery)""", "fact_delivery"))
def _(t):
    return rounded(d.load_throughput(_loaded(t)), "rows_per_second", digits=9)


@query("g15_data_health_snapshot", sql(f"""
    SELECT DATE '2002-01-01' AS report_date, total_rows, valid_records, overall_health_pct,
      CASE WHEN overall_health_pct >= 98 THEN 'EXCELLENT' WHEN overall_health_pct >= 90 THEN 'WARNING' ELSE 'CRITICAL' END AS health_status
    FROM (SELECT {n()} AS total_rows, {count_if("rider_id IS NOT NULL AND city IS NOT NULL AND delivery_status = 'success'")} AS valid_records,
      {half_up(count_if("rider_id IS NOT NULL AND city IS NOT NULL AND delivery_status = 'success'") + " * 100.0::DOUBLE / COUNT(*)")} AS overall_health_pct
      FROM fact_delivery)""", "fact_delivery"))
def _(t):
    facts = d.delivery_performance(b.orders(t), b.deliveries(t), b.cancellations(t))
    scores = health_score(facts, ["order_id", "rider_id", "city"], "delivery_status", ["success"])
    return d.health_snapshot(scores.withColumn("processed_at", F.lit("2002-01-01").cast("date")))


@query("g16_mart_freshness", sql(f"""
    SELECT a.ts AS last_source_event, f.ts AS last_silver_update, g.ts AS last_gold_update,
      {half_up("date_diff('second', a.ts, g.ts) / 60.0::DOUBLE")} AS e2e_latency_min, TIMESTAMP '2002-01-01' AS monitored_at
    FROM (SELECT MAX(created_ts) AS ts FROM ow_orders) a, (SELECT MAX(drop_ts) AS ts FROM fact_delivery) f,
      (SELECT MAX(promised_ts) AS ts FROM gold_deliveries) g""", "ow_orders", "fact_delivery", "gold_deliveries"))
def _(t):
    facts = d.delivery_performance(b.orders(t), b.deliveries(t), b.cancellations(t))
    return d.freshness([("last_source_event", b.orders(t), "created_ts"), ("last_silver_update", facts, "drop_ts"),
                        ("last_gold_update", gold_deliveries(t), "promised_ts")], F.lit("2002-01-01").cast("timestamp_ntz"))


@query("p20_standardised_text", sql("""
    SELECT rider_id, UPPER(TRIM('  ' || rider_name || ' ')) AS upper_name, LOWER(TRIM(rider_name)) AS lower_name,
      vehicle_type FROM ow_riders""", "ow_riders"))
def _(t):
    padded = F.concat(F.lit("  "), F.col("rider_name"), F.lit(" "))
    return b.riders(t).select("rider_id", tidy(padded, "upper").alias("upper_name"), tidy("rider_name", "lower").alias("lower_name"),
                              tidy("vehicle_type").alias("vehicle_type"))
