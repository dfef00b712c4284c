"""Facts, metrics and gold tables of the delivery model.

Pure functions of their input tables. ``as_of`` stamps the output; leave it out
for the current time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.functions.columns import (exact_avg, exact_sum, hours_between, ladder, minutes_between, on_time,
                                        pct, seconds_between, zero_if_null)


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


# --- facts --------------------------------------------------------------------

def delivery_performance(orders: DataFrame, deliveries: DataFrame, cancellations: DataFrame,
                         as_of: Column | None = None) -> DataFrame:
    """Every order with its delivery and cancellation outcome."""
    o = orders.select("order_id", "customer_id", "city", "created_ts", "promised_ts", "order_status",
                      "estimated_distance_km", "estimated_duration_min")
    d = deliveries.select("order_id", "rider_id", "drop_ts", "delivery_status", "distance_km_actual",
                          "duration_min_actual")
    c = cancellations.select("order_id", "cancel_reason_code", "cancel_actor")
    return o.join(d, "order_id", "left").join(c, "order_id", "left").withColumns({
        "distance_variance_km": F.col("distance_km_actual") - F.col("estimated_distance_km"),
        "actual_total_time_min": minutes_between("created_ts", "drop_ts"),
        "is_on_time_flag": on_time("drop_ts", "promised_ts"),
        "fact_load_timestamp": _now(as_of),
    })


def financials(orders: DataFrame, pricing: DataFrame, support: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Net revenue and margin per priced order; compensation is summed per order before the join."""
    refunds = support.groupBy("order_id").agg(exact_sum("compensation_amount", 4).alias("refunded"))
    priced = orders.select("order_id", "city", "created_ts", "order_value").join(
        pricing.select("order_id", "base_fare", "surge_multiplier", "service_fee", "discount_amount"), "order_id")
    joined = priced.join(refunds, "order_id", "left").withColumn("total_refunded_amount", zero_if_null("refunded"))
    kept = F.col("order_value") - F.col("total_refunded_amount")
    return joined.drop("refunded").withColumns({
        "net_revenue": kept + F.col("service_fee") - F.col("discount_amount"),
        "order_margin_percentage": pct(kept, "order_value"),
        "fact_load_timestamp": _now(as_of),
    })


def rider_productivity(riders: DataFrame, shifts: DataFrame, pings: DataFrame, per_delivery: bool = False,
                       as_of: Column | None = None) -> DataFrame:
    """Shift hours with GPS activity.

    Pings are summarised per rider, giving one row per shift. ``per_delivery``
    summarises them per rider and delivery, which repeats a shift once for every
    delivery its rider ever pinged.
    """
    grain = ["rider_id", "delivery_id"] if per_delivery else ["rider_id"]
    activity = pings.groupBy(*grain).agg(F.count("ping_id").alias("total_pings"),
                                         F.max("speed_kmh").alias("max_recorded_speed_kmh"))
    worked = shifts.drop("city").join(riders.select("rider_id", "city", "vehicle_type"), "rider_id")
    return worked.join(activity, "rider_id", "left").select(
        "shift_id", "rider_id", "city", "vehicle_type", "shift_start_ts", "actual_login_ts", "actual_logout_ts",
        "scheduled_hours",
        hours_between("actual_login_ts", "actual_logout_ts").alias("actual_hours_worked"),
        F.col("late_start_flag").cast("int").alias("is_late_start_flag"),
        F.col("overtime_flag").cast("int").alias("is_overtime_flag"),
        (zero_if_null("total_pings") > 0).cast("int").alias("has_gps_activity_flag"),
        "max_recorded_speed_kmh",
        _now(as_of).alias("fact_load_timestamp"))


def customer_experience(orders: DataFrame, deliveries: DataFrame, support: DataFrame, as_of: Column | None = None
                        ) -> DataFrame:
    """Orders with their rating and tickets, flagged when anything went wrong for the customer."""
    joined = (orders.select("order_id", "customer_id", "city", "created_ts", "order_status")
              .join(deliveries.select("order_id", "customer_rating", "delivery_status"), "order_id", "left")
              .join(support.select("order_id", "ticket_id", "issue_category", "compensation_amount", "csat_score"),
                    "order_id", "left"))
    ticket = F.col("ticket_id").isNotNull()
    friction = ticket | (F.col("customer_rating") <= 2) | (F.col("order_status") == "cancel")
    return joined.withColumns({
        "has_support_ticket_flag": ticket.cast("int"),
        "is_friction_event_flag": F.coalesce(friction.cast("int"), F.lit(0)),
        "fact_load_timestamp": _now(as_of),
        "transformation_source": F.lit("SILVER_JOIN"),
    }).drop("order_status")


# --- gold operational tables --------------------------------------------------

def order_facts(orders: DataFrame, pricing: DataFrame, cancellations: DataFrame, as_of: Column | None = None
                ) -> DataFrame:
    """One wide row per order with calendar parts, net revenue and outcome flags."""
    wide = (orders.select("order_id", "customer_id", "city", "order_status", "created_ts", "order_value")
            .join(pricing.select("order_id", "service_fee", "discount_amount"), "order_id", "left")
            .join(cancellations.select("order_id", "cancel_reason_code"), "order_id", "left"))
    fee, discount = zero_if_null("service_fee"), zero_if_null("discount_amount")
    flag = lambda outcome: F.coalesce((F.col("order_status") == outcome).cast("int"), F.lit(0))
    return wide.withColumns({
        "order_date": F.to_date("created_ts"),
        "order_hour": F.hour("created_ts"),
        "day_name": F.date_format("created_ts", "EEEE"),
        "service_fee": fee,
        "discount_amount": discount,
        "net_revenue": F.col("order_value") + fee - discount,
        "is_success_flag": flag("success"),
        "is_cancelled_flag": flag("cancel"),
        "gold_ingestion_ts": _now(as_of),
    })


def delivery_facts(deliveries: DataFrame, orders: DataFrame, riders: DataFrame, as_of: Column | None = None
                   ) -> DataFrame:
    """One row per delivery with speed, delay (negative when early) and distance variance."""
    d = deliveries.select("delivery_id", "order_id", "rider_id", "delivery_status", "drop_ts", "distance_km_actual")
    o = orders.select("order_id", "city", "created_ts", "promised_ts", "estimated_distance_km")
    wide = d.join(o, "order_id").join(riders.select("rider_id", "vehicle_type"), "rider_id", "left")
    return wide.withColumns({
        "total_delivery_time_min": minutes_between("created_ts", "drop_ts"),
        "delay_minutes": minutes_between("promised_ts", "drop_ts"),
        "is_on_time_flag": on_time("drop_ts", "promised_ts"),
        "distance_variance": F.col("distance_km_actual") - F.col("estimated_distance_km"),
        "delivery_date": F.to_date("created_ts"),
        "gold_ingestion_ts": _now(as_of),
    })


def rider_daily_summary(shifts: DataFrame, delivery_mart: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Deliveries per rider and day next to the shift that started that day."""
    daily = delivery_mart.groupBy("rider_id", "delivery_date").agg(
        F.count("delivery_id").alias("total_completed_deliveries"),
        F.sum("is_on_time_flag").alias("on_time"),
        exact_sum("distance_km_actual", 4).alias("total_km_driven"))
    worked = shifts.select("rider_id", F.to_date("shift_start_ts").alias("delivery_date"), "scheduled_hours",
                           hours_between("actual_login_ts", "actual_logout_ts").alias("actual_online_hours"))
    done = F.col("total_completed_deliveries")
    return worked.join(daily, ["rider_id", "delivery_date"]).withColumns({
        "deliveries_per_hour": F.try_divide(done, "actual_online_hours"),
        "on_time_rate": F.try_divide("on_time", done),
        "gold_ingestion_ts": _now(as_of),
    }).drop("on_time")


# --- gold KPIs ----------------------------------------------------------------

def city_operations(order_mart: DataFrame, shifts: DataFrame, under: float = 5, over: float = 1,
                    as_of: Column | None = None) -> DataFrame:
    """Orders per logged-in rider by city and hour. ``over`` and ``under`` are the ratio limits."""
    grain = ["city", "order_date", "order_hour"]
    demand = order_mart.groupBy(*grain).agg(F.count("order_id").alias("demand_order_count"))
    logged_in = shifts.select("city", "rider_id", F.to_date("actual_login_ts").alias("order_date"),
                              F.hour("actual_login_ts").alias("order_hour"))
    supply = logged_in.groupBy(*grain).agg(F.countDistinct("rider_id").alias("supply_rider_count"))
    ratio = F.try_divide("demand_order_count", "supply_rider_count")
    return demand.join(supply, grain).withColumns({
        "orders_per_rider_ratio": F.round(ratio, 2),
        "market_status": ladder([(ratio > under, "UNDER_SUPPLIED"), (ratio < over, "OVER_SUPPLIED")], "BALANCED"),
        "gold_ingestion_ts": _now(as_of),
    })


def customer_experience_kpis(order_mart: DataFrame, support: DataFrame, refund_label: str = "refund",
                             as_of: Column | None = None) -> DataFrame:
    """Contact and refund rates per city and day."""
    days = ["city", "report_date"]
    located = support.join(order_mart.select("order_id", "city"), "order_id", "left").groupBy(
        "city", F.to_date("created_ts").alias("report_date")).agg(
        F.count("ticket_id").alias("total_support_tickets"),
        F.round(F.avg("csat_score"), 2).alias("avg_csat"),
        F.count_if(F.col("issue_category") == refund_label).alias("refunds"))
    placed = order_mart.groupBy("city", F.col("order_date").alias("report_date")).agg(
        F.count("order_id").alias("total_orders"))
    return located.join(placed, days).select(
        *days, "avg_csat", "total_support_tickets",
        pct("total_support_tickets", "total_orders").alias("contact_rate_pct"),
        pct("refunds", "total_orders").alias("refund_rate_pct"),
        _now(as_of).alias("gold_ingestion_ts"))


def delivery_kpis(order_mart: DataFrame, delivery_mart: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Volume, revenue, cancellation and punctuality per city and day.

    Both sides are aggregated to (city, day) before they meet.
    """
    sold = order_mart.groupBy("city", F.col("order_date").alias("report_date")).agg(
        F.count("order_id").alias("total_orders_placed"),
        F.sum("is_success_flag").alias("total_completed_orders"),
        F.sum("is_cancelled_flag").alias("total_cancelled_orders"),
        exact_sum("net_revenue", 4).alias("revenue"),
        exact_avg("order_value").alias("basket"))
    driven = delivery_mart.groupBy("city", F.col("delivery_date").alias("report_date")).agg(
        exact_avg("total_delivery_time_min", 6).alias("minutes"),
        F.try_divide(F.sum("is_on_time_flag"), F.count("delivery_id")).alias("punctual"))
    return sold.join(driven, ["city", "report_date"]).select(
        "city", "report_date", "total_orders_placed", "total_completed_orders", "total_cancelled_orders",
        F.try_divide("total_cancelled_orders", "total_orders_placed").alias("cancellation_rate"),
        F.round("revenue", 2).alias("net_revenue"),
        F.round("basket", 2).alias("avg_basket_value"),
        F.round("punctual", 4).alias("otd_pct"),
        F.round("minutes", 2).alias("avg_delivery_min"),
        _now(as_of).alias("gold_ingestion_ts"))


def rider_performance(daily: DataFrame, elite: int = 500, pro: int = 100, as_of: Column | None = None) -> DataFrame:
    """Rider roll-up of the daily summary with a tier and a weighted reliability score."""
    total = daily.groupBy("rider_id").agg(
        F.count("delivery_date").alias("days_active"),
        F.sum("total_completed_deliveries").alias("total_lifetime_deliveries"),
        exact_avg("deliveries_per_hour", 9).alias("dph"),
        exact_avg("on_time_rate", 9).alias("otd"))
    deliveries = F.col("total_lifetime_deliveries")
    return total.select(
        "rider_id", ladder([(deliveries > elite, "ELITE"), (deliveries > pro, "PRO")], "ROOKIE").alias("rider_tier"),
        "days_active", "total_lifetime_deliveries",
        F.round("dph", 2).alias("avg_dph"), F.round("otd", 4).alias("lifetime_otd_pct"),
        F.round(F.col("otd") * 0.7 + F.col("dph") * 0.3, 2).alias("reliability_score"),
        _now(as_of).alias("gold_ingestion_ts"))


# --- monitoring ---------------------------------------------------------------

def ingestion_latency(facts: DataFrame, event: str = "created_ts", loaded: str = "fact_load_timestamp") -> DataFrame:
    """Delay from event to load per city; the 95th percentile is a value of the data."""
    delays = facts.select("city", seconds_between(event, loaded).alias("delay"))
    return delays.groupBy("city").agg(
        F.avg("delay").alias("avg_delay_sec"),
        F.percentile_approx("delay", 0.95).alias("p95_delay_sec"),
        F.max("delay").alias("max_spike_sec"),
        F.count(F.lit(1)).alias("sample_size"))


def load_throughput(facts: DataFrame, loaded: str = "fact_load_timestamp") -> DataFrame:
    """Rows and rows per second between the first and last load; NULL when they coincide."""
    span = facts.agg(F.count(F.lit(1)).alias("total_rows_processed"), F.min(loaded).alias("start_time"),
                     F.max(loaded).alias("end_time"))
    length = F.greatest(seconds_between("start_time", "end_time"), F.lit(0))
    return span.withColumn("processing_duration_sec", length).withColumn(
        "rows_per_second", F.try_divide("total_rows_processed", "processing_duration_sec"))


def health_snapshot(scores: DataFrame, processed_at: str = "processed_at") -> DataFrame:
    """Health scores with a label."""
    score = F.col("overall_health_pct")
    return scores.select(
        F.to_date(processed_at).alias("report_date"), F.col("total_records").alias("total_rows"), "valid_records",
        "overall_health_pct",
        ladder([(score >= 98, "EXCELLENT"), (score >= 90, "WARNING")], "CRITICAL").alias("health_status"))


def freshness(stages: Sequence[tuple[str, DataFrame, str]], as_of: Column | None = None) -> DataFrame:
    """Newest timestamp of each stage (output column, table, timestamp column), the minutes from the first
    stage to the last, 0 when either is empty, and when it was looked at. One plan, nothing collected."""
    newest = {name: df.agg(F.max(ts)).scalar() for name, df, ts in stages}
    spark = stages[0][1].sparkSession
    first, last = stages[0][0], stages[-1][0]
    lag = F.round(minutes_between(first, last), 2)
    return spark.range(1).select(*[c.alias(n) for n, c in newest.items()]).withColumn(
        "e2e_latency_min", F.coalesce(lag, F.lit(0.0))).withColumn("monitored_at", F.current_timestamp() if as_of is None else as_of)
