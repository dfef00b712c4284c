"""The driver tables seen as the entities of the data model.

Pure projections and joins: a query that uses three columns scans three columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.checks.registry import Tables
from medalyst.functions.columns import exact_sum
from medalyst.operators.dedupe import top_per_key
from medalyst.plans.subscribers import priced

RETAIL_AS_OF = "2002-01-01"
SPEND = [f"spend_{t}" for t in ("economy", "large", "medium", "promo", "small", "standard")]
CHANNELS = ["web_purchases", "store_purchases", "catalog_purchases"]
DEVICES = {"click": "Mobile", "view": "TV", "purchase": "Laptop", "signup": "Tablet", "error": "Web"}


# --- orders as deliveries (dates 1995-2001) -------------------------------------

def orders(t: Tables) -> DataFrame:
    placed = t.orders.join(t.customer, F.expr("o_custkey = c_custkey")).join(t.nation, F.expr("c_nationkey = n_nationkey"))
    return placed.selectExpr(
        "o_orderkey AS order_id", "o_custkey AS customer_id", "n_name AS city", "o_orderpriority AS delivery_zone",
        "o_orderdate AS created_ts", "o_orderdate + make_dt_interval(0, 0, int(o_orderkey % 5) - 1) AS accepted_ts",
        "o_orderdate + INTERVAL 365 DAYS AS promised_ts", "double(o_custkey % 14 + 2) AS estimated_distance_km",
        "int(20 + o_orderkey % 41) AS estimated_duration_min", "o_totalprice AS order_value",
        "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'cancel' ELSE 'fail' END AS order_status",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Paid' WHEN '2-HIGH' THEN 'Paid' WHEN '3-MEDIUM' THEN 'Pending' "
        "WHEN '5-LOW' THEN 'Failed' ELSE 'Unknown' END AS payment_status", "o_orderdate AS ingestion_ts")


def deliveries(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.expr("l_orderkey = o_orderkey"))
    return lines.selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS delivery_id", "l_orderkey AS order_id", "l_suppkey AS rider_id",
        "o_orderdate AS dispatch_ts", "l_shipdate AS pickup_ts",
        "CASE WHEN l_linestatus = 'F' THEN l_shipdate + make_dt_interval(0, 0, int(l_quantity)) END AS drop_ts",
        "CASE l_linestatus WHEN 'F' THEN 'success' ELSE 'cancel' END AS delivery_status",
        "l_quantity AS distance_km_actual", "int(30 * l_linenumber) AS duration_min_actual",
        "int(1 + l_linenumber % 6) AS customer_rating", "int(1 + l_partkey % 5) AS rider_rating",
        "l_shipdate AS ingestion_ts", "l_partkey AS tie_a", "l_suppkey AS tie_b", "l_extendedprice AS tie_c")


def pricing(t: Tables) -> DataFrame:
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        exact_sum(F.col("l_extendedprice") * F.col("l_tax"), 4).alias("service_fee"),
        exact_sum(F.col("l_extendedprice") * F.col("l_discount"), 4).alias("discount_amount"),
        F.max("l_discount").alias("_d"),
        exact_sum(F.expr("l_extendedprice * (1 - l_discount) * (1 + l_tax)"), 6).alias("final_customer_price"))
    return per_order.withColumns({"pricing_event_id": F.col("order_id"), "base_fare": F.lit(5.0),
                                  "surge_multiplier": 1 + F.col("_d")}).drop("_d")


def cancellations(t: Tables) -> DataFrame:
    gone = t.orders.where("o_orderstatus = 'P'").join(t.customer, F.expr("o_custkey = c_custkey"))
    return gone.selectExpr(
        "o_orderkey AS cancel_id", "o_orderkey AS order_id", "o_orderdate + INTERVAL 10 MINUTES AS cancel_ts",
        "element_at(array('Customer', 'Rider', 'System'), int(o_orderkey % 3) + 1) AS cancel_actor",
        "o_orderpriority AS cancel_reason_code", "c_acctbal / 50 AS refund_amount", "2.0D AS compensation_paid",
        "o_orderdate AS ingestion_ts")


def support(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'R'").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS ticket_id", "l_orderkey AS order_id",
        "l_extendedprice * l_discount AS compensation_amount", "int(1 + l_linenumber % 5) AS csat_score",
        "l_linestatus AS issue_category", "l_shipdate AS created_ts")


def riders(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.expr("s_nationkey = n_nationkey")).selectExpr(
        "s_suppkey AS rider_id", "s_name AS rider_name", "n_name AS city", "s_acctbal / 2000 AS rating_avg",
        "element_at(array('scooter', 'bike', 'car'), int(s_suppkey % 3) + 1) AS vehicle_type")


# --- events as shifts, pings and tickets (January 2024) ---------------------------

def _events(t: Tables, kind: str) -> DataFrame:
    return t.events.where(F.col("event_type") == kind).withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _cities(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.expr("c_nationkey = n_nationkey")).selectExpr("c_custkey AS user_id", "n_name AS city")


def live_orders(t: Tables) -> DataFrame:
    return _events(t, "purchase").join(_cities(t), "user_id").selectExpr(
        "event_id AS order_id", "user_id AS customer_id", "city", "ts AS created_ts", "value AS order_value",
        "CASE WHEN k < 75 THEN 'success' WHEN k < 90 THEN 'cancel' ELSE 'fail' END AS order_status",
        "to_date(ts) AS order_date", "hour(ts) AS order_hour")


def live_deliveries(t: Tables) -> DataFrame:
    """Shaped like the gold delivery table."""
    return _events(t, "click").selectExpr(
        "event_id AS delivery_id", "user_id AS rider_id", "to_date(ts) AS delivery_date", "value / 10 AS distance_km_actual",
        "int(k < 80) AS is_on_time_flag", "value AS total_delivery_time_min")


def live_shifts(t: Tables) -> DataFrame:
    return _events(t, "signup").join(_cities(t), "user_id").selectExpr(
        "event_id AS shift_id", "user_id AS rider_id", "city", "ts AS shift_start_ts", "ts AS actual_login_ts",
        "ts + make_dt_interval(0, 0, 0, round(value * 60)) AS actual_logout_ts", "value / 60 AS scheduled_hours",
        "k % 2 = 1 AS late_start_flag", "k % 3 = 1 AS overtime_flag")


def live_support(t: Tables) -> DataFrame:
    return _events(t, "error").selectExpr(
        "event_id AS ticket_id", "user_id", "ts AS created_ts", "int(1 + k % 5) AS csat_score",
        "CASE WHEN k < 30 THEN 'refund' ELSE 'late' END AS issue_category", "value AS compensation_amount")


def live_pings(t: Tables) -> DataFrame:
    return _events(t, "view").selectExpr(
        "event_id AS ping_id", "user_id AS rider_id", "k AS delivery_id", "int(value) AS speed_kmh",
        "k AS battery_level", "ts AS ping_ts")


def live_riders(t: Tables) -> DataFrame:
    return _cities(t).selectExpr(
        "user_id AS rider_id", "city", "element_at(array('scooter', 'bike', 'car'), int(user_id % 3) + 1) AS vehicle_type")


# --- retail customers ---------------------------------------------------------------

def customers(t: Tables) -> DataFrame:
    kinds = [c.removeprefix("spend_").upper() for c in SPEND]
    spend = (t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).join(t.orders, F.expr("l_orderkey = o_orderkey"))
             .groupBy("o_custkey").agg(*[
                 exact_sum(F.when(F.col("p_type") == k, F.col("l_extendedprice"))).alias(c) for k, c in zip(kinds, SPEND)]))
    channel = {"web_purchases": "1-URGENT", "store_purchases": "2-HIGH", "catalog_purchases": "3-MEDIUM",
               "web_visits": "4-NOT SPECIFIED", "deals": "5-LOW"}
    bought = t.orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("customer_since"),
        F.datediff(F.lit(RETAIL_AS_OF).cast("date"), F.to_date(F.max("o_orderdate"))).alias("recency_days"),
        *[F.count_if(F.col("o_orderpriority") == p).alias(c) for c, p in channel.items()])
    base = t.customer.selectExpr(
        "c_custkey AS id", "int(1940 + c_custkey % 60) AS birth_year", "c_mktsegment AS education",
        "element_at(array('Single', 'Couple', 'Family'), int(c_custkey % 3) + 1) AS household",
        "CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS income", "int(c_custkey % 3) AS kids", "int(c_custkey % 2) AS teens")
    joined = base.join(bought.withColumnRenamed("o_custkey", "id"), "id", "left").join(
        spend.withColumnRenamed("o_custkey", "id"), "id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in SPEND})


# --- subscribers ----------------------------------------------------------------------

def subscribers(t: Tables) -> DataFrame:
    dated = t.orders.select(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("d"), "o_orderkey")
    firsts = top_per_key(dated, ["user_id"], [F.asc("d"), F.asc("o_orderkey")], 2, rank_as="r").groupBy("user_id").agg(
        F.max(F.when(F.col("r") == 1, F.col("d"))).alias("subscription_date"),
        F.max(F.when(F.col("r") == 2, F.col("d"))).alias("plan_change_date"))
    lasts = dated.groupBy("user_id").agg(F.max("d").alias("last_order"))
    plan = lambda n: (f"CASE int((c_custkey div {n}) % 3) WHEN 0 THEN 'Free' WHEN 1 THEN "  # noqa: E731
                      "IF(c_custkey % 2 = 0, 'Basic', 'VIP') ELSE 'Premium' END")
    people = t.customer.selectExpr(
        "c_custkey AS user_id", "IF(c_custkey % 2 = 0, 'A', 'B') AS platform",
        "element_at(array('18-24', '25-34', '35-44', '45+'), int((c_custkey div 2) % 4) + 1) AS age_group",
        "concat('Tier ', int(1 + c_nationkey % 3)) AS city_tier", f"{plan(2)} AS subscription_plan",
        f"{plan(7)} AS new_subscription_plan", "c_acctbal")
    joined = people.join(firsts, "user_id", "left").join(lasts, "user_id", "left")
    known = joined.withColumn("last_active_date", F.when(F.col("c_acctbal") <= 5000, F.col("last_order")))
    return priced(known.withColumn("inactivity_flag", F.col("last_active_date").isNotNull().cast("int"))).drop(
        "c_acctbal", "last_order")


def consumption(t: Tables) -> DataFrame:
    device = F.expr("CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DEVICES.items()) + " END")
    return t.events.groupBy("user_id", device.alias("device_type")).agg(exact_sum("value").alias("watch_mins"))


def engagement(t: Tables) -> DataFrame:
    return consumption(t).join(subscribers(t), "user_id")


def viewers(t: Tables) -> DataFrame:
    """Subscribers with their total watch time, zero when they watched nothing."""
    watched = t.events.groupBy("user_id").agg(exact_sum("value").alias("watch_mins"))
    return subscribers(t).join(watched, "user_id", "left").withColumn("watch_mins", F.coalesce("watch_mins", F.lit(0.0)))


# --- contest ----------------------------------------------------------------------------

def matches(t: Tables) -> DataFrame:
    home = t.nation.selectExpr("n_nationkey AS hk", "n_name AS team1", "n_regionkey")
    away = t.nation.selectExpr("n_nationkey AS ak", "n_name AS team2")
    m = (t.orders.join(t.customer, F.expr("o_custkey = c_custkey")).join(home, F.expr("c_nationkey = hk"))
         .join(t.region, F.expr("n_regionkey = r_regionkey"))
         .join(away, F.expr("int((c_nationkey + 1 + o_orderkey % 24) % 25) = ak")))
    return m.selectExpr(
        "o_orderkey AS id", "to_date(o_orderdate) AS date", "year(o_orderdate) AS season", "r_name AS venue", "team1", "team2",
        "CASE o_orderstatus WHEN 'F' THEN team1 WHEN 'O' THEN team2 END AS winner",
        "IF(o_orderkey % 2 = 0, team1, team2) AS toss_winner", "o_orderpriority AS toss_decision",
        "CASE o_orderstatus WHEN 'F' THEN 'runs' WHEN 'O' THEN 'wickets' END AS result",
        "int(o_orderkey % 150 + 1) AS result_margin", "concat('U', o_orderkey % 20) AS umpire1",
        "concat('U', o_orderkey % 23) AS umpire2", "concat('P', o_custkey % 50) AS player_of_match")


def balls(t: Tables, with_teams: bool = False) -> DataFrame:
    b = t.lineitem.selectExpr(
        "l_orderkey AS id", "int(1 + l_linenumber % 2) AS inning", "int(l_quantity) % 20 AS over", "l_suppkey AS batsman",
        "l_partkey % 50 AS bowler", "l_linenumber AS batsman_runs", "l_linenumber + int(l_returnflag = 'R') AS total_runs",
        "int(l_returnflag = 'A') AS is_wicket")
    if not with_teams:
        return b
    teams = matches(t).select("id", "team1", "team2")
    return b.join(teams, "id").selectExpr(
        "*", "IF(inning = 1, team1, team2) AS batting_team", "IF(inning = 1, team2, team1) AS bowling_team").drop("team1", "team2")


# --- registrations ----------------------------------------------------------------------

def vehicles(t: Tables) -> DataFrame:
    v = (t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).join(t.supplier, F.expr("l_suppkey = s_suppkey"))
         .join(t.nation, F.expr("s_nationkey = n_nationkey")))
    return v.selectExpr(
        "n_name AS county", "s_name AS city", "p_brand AS make", "p_name AS model", "year(l_shipdate) AS model_year",
        "IF(l_linestatus = 'F', 'BEV', 'PHEV') AS ev_type",
        "CASE l_returnflag WHEN 'A' THEN 'Eligible' WHEN 'N' THEN 'Unknown' ELSE 'Not eligible' END AS cafv",
        "p_size AS electric_range", "IF(l_returnflag = 'N', 0.0D, p_retailprice) AS base_msrp",
        "concat(p_type, '||', p_brand) AS electric_utility", "l_suppkey AS census_tract")


# --- equipment --------------------------------------------------------------------------

def machine_runs(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_suppkey AS machine", "int(l_linenumber % 3) AS shift", "60 * l_quantity AS planned_min",
        "60 * l_quantity * (1 - l_tax) AS run_min", "1 / (1 + l_discount) AS ideal_min", "l_quantity AS units",
        "IF(l_returnflag = 'R', l_quantity, 0.0D) AS rejects", "60 * (1 - l_tax) AS cycle_min")


def stops(t: Tables) -> DataFrame:
    return _events(t, "error").selectExpr(
        "user_id AS machine", "value AS minutes",
        "element_at(array('planned', 'unplanned', 'minor'), int(k % 3) + 1) AS category")
