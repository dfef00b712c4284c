"""Building blocks of the oracle SQL: the same entity views as ``bindings``, for DuckDB."""

from __future__ import annotations


def _decimal(x: str) -> str:
    """The shortest decimal form of a double: what both engines print, and what Spark rounds."""
    return f"CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18))"


def half_up(x: str, digits: int = 2) -> str:
    """Round half away from zero on the decimal form of a double, as Spark does."""
    return f"CAST(ROUND({_decimal(x)}, {digits}) AS DOUBLE)"


def half_even(x: str, digits: int = 2) -> str:
    """Round half to even on the decimal form of a double."""
    d = _decimal(x)
    away = f"ROUND({d}, {digits})"
    unit = "1" if digits == 0 else "0." + "0" * (digits - 1) + "1"
    half = "0." + "0" * digits + "5"
    tie = f"ABS({away} - {d}) = {half}"
    odd = f"CAST(ROUND(CAST({away} AS DOUBLE) * {10 ** digits}) AS BIGINT) % 2 <> 0"
    return f"CAST(CASE WHEN {tie} AND {odd} THEN {away} - SIGN({d}) * {unit} ELSE {away} END AS DOUBLE)"


def money(x: str, scale: int = 2) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def money_avg(x: str, scale: int = 2) -> str:
    return f"({money(x, scale)} / NULLIF(COUNT({x}), 0))"


def n(x: str = "*") -> str:
    return f"CAST(COUNT({x}) AS BIGINT)"


def total(x: str) -> str:
    """Sum of integers as BIGINT."""
    return f"CAST(SUM({x}) AS BIGINT)"


def count_if(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"


_PLAN = """CASE (c_custkey // {0}) % 3 WHEN 0 THEN 'Free' WHEN 1 THEN CASE WHEN c_custkey % 2 = 0 THEN 'Basic' ELSE 'VIP' END
ELSE 'Premium' END"""
_K = "CAST(regexp_extract(props, ': ([0-9]+)', 1) AS INTEGER)"
_SPEND = ",\n".join(f"COALESCE({money(f'CASE WHEN p_type = {t!r} THEN l_extendedprice END')}, 0.0) AS spend_{t.lower()}"
                    for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ow_orders": ((), """SELECT o_orderkey AS order_id, o_custkey AS customer_id, n_name AS city, o_orderpriority AS delivery_zone,
        o_orderdate AS created_ts, o_orderdate + to_minutes(o_orderkey % 5 - 1) AS accepted_ts,
        o_orderdate + INTERVAL 365 DAY AS promised_ts, CAST(o_custkey % 14 + 2 AS DOUBLE) AS estimated_distance_km,
        CAST(20 + o_orderkey % 41 AS INTEGER) AS estimated_duration_min, o_totalprice AS order_value,
        CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'cancel' ELSE 'fail' END AS order_status,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Paid' WHEN '2-HIGH' THEN 'Paid' WHEN '3-MEDIUM' THEN 'Pending'
          WHEN '5-LOW' THEN 'Failed' ELSE 'Unknown' END AS payment_status, o_orderdate AS ingestion_ts
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""),
    "ow_deliveries": ((), """SELECT l_orderkey || '-' || l_linenumber AS delivery_id, l_orderkey AS order_id, l_suppkey AS rider_id,
        o_orderdate AS dispatch_ts, l_shipdate AS pickup_ts,
        CASE WHEN l_linestatus = 'F' THEN l_shipdate + to_minutes(CAST(l_quantity AS BIGINT)) END AS drop_ts,
        CASE l_linestatus WHEN 'F' THEN 'success' ELSE 'cancel' END AS delivery_status, l_quantity AS distance_km_actual,
        CAST(30 * l_linenumber AS INTEGER) AS duration_min_actual, CAST(1 + l_linenumber % 6 AS INTEGER) AS customer_rating,
        CAST(1 + l_partkey % 5 AS INTEGER) AS rider_rating, l_shipdate AS ingestion_ts, l_partkey AS tie_a, l_suppkey AS tie_b,
        l_extendedprice AS tie_c FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "ow_pricing": ((), f"""SELECT l_orderkey AS order_id, l_orderkey AS pricing_event_id, 5.0::DOUBLE AS base_fare,
        {money('l_extendedprice * l_tax', 4)} AS service_fee, {money('l_extendedprice * l_discount', 4)} AS discount_amount,
        1 + MAX(l_discount) AS surge_multiplier,
        {money('l_extendedprice * (1 - l_discount) * (1 + l_tax)', 6)} AS final_customer_price FROM lineitem GROUP BY l_orderkey"""),
    "ow_cancels": ((), """SELECT o_orderkey AS cancel_id, o_orderkey AS order_id, o_orderdate + INTERVAL 10 MINUTE AS cancel_ts,
        CASE o_orderkey % 3 WHEN 0 THEN 'Customer' WHEN 1 THEN 'Rider' ELSE 'System' END AS cancel_actor,
        o_orderpriority AS cancel_reason_code, c_acctbal / 50 AS refund_amount, 2.0::DOUBLE AS compensation_paid,
        o_orderdate AS ingestion_ts FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'"""),
    "ow_support": ((), """SELECT l_orderkey || '-' || l_linenumber AS ticket_id, l_orderkey AS order_id,
        l_extendedprice * l_discount AS compensation_amount, CAST(1 + l_linenumber % 5 AS INTEGER) AS csat_score,
        l_linestatus AS issue_category, l_shipdate AS created_ts FROM lineitem WHERE l_returnflag = 'R'"""),
    "ow_riders": ((), """SELECT s_suppkey AS rider_id, s_name AS rider_name, n_name AS city, s_acctbal / 2000 AS rating_avg,
        CASE s_suppkey % 3 WHEN 0 THEN 'scooter' WHEN 1 THEN 'bike' ELSE 'car' END AS vehicle_type
        FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    "gold_orders": (("ow_orders", "ow_pricing", "ow_cancels"), """SELECT o.order_id, o.customer_id, o.city, o.order_status, o.created_ts,
        CAST(o.created_ts AS DATE) AS order_date, CAST(hour(o.created_ts) AS INTEGER) AS order_hour, dayname(o.created_ts) AS day_name,
        o.order_value, COALESCE(p.service_fee, 0) AS service_fee, COALESCE(p.discount_amount, 0) AS discount_amount,
        o.order_value + COALESCE(p.service_fee, 0) - COALESCE(p.discount_amount, 0) AS net_revenue,
        CAST(o.order_status = 'success' AS INTEGER) AS is_success_flag, CAST(o.order_status = 'cancel' AS INTEGER) AS is_cancelled_flag,
        c.cancel_reason_code FROM ow_orders o LEFT JOIN ow_pricing p USING (order_id) LEFT JOIN ow_cancels c USING (order_id)"""),
    "gold_deliveries": (("ow_orders", "ow_deliveries", "ow_riders"), """SELECT d.delivery_id, d.order_id, d.rider_id, o.city, r.vehicle_type,
        d.delivery_status, o.created_ts, o.promised_ts, d.drop_ts, date_diff('second', o.created_ts, d.drop_ts) / 60.0::DOUBLE AS total_delivery_time_min,
        CAST(d.drop_ts <= o.promised_ts AS INTEGER) AS is_on_time_flag,
        date_diff('second', o.promised_ts, d.drop_ts) / 60.0::DOUBLE AS delay_minutes, o.estimated_distance_km, d.distance_km_actual,
        d.distance_km_actual - o.estimated_distance_km AS distance_variance, CAST(o.created_ts AS DATE) AS delivery_date
        FROM ow_deliveries d JOIN ow_orders o USING (order_id) LEFT JOIN ow_riders r USING (rider_id)"""),
    "fact_delivery": (("ow_orders", "ow_deliveries", "ow_cancels"), """SELECT o.order_id, o.customer_id, d.rider_id, o.city, o.created_ts,
        o.promised_ts, d.drop_ts, o.order_status, d.delivery_status, o.estimated_distance_km, d.distance_km_actual,
        d.distance_km_actual - o.estimated_distance_km AS distance_variance_km, o.estimated_duration_min, d.duration_min_actual,
        date_diff('second', o.created_ts, d.drop_ts) / 60.0::DOUBLE AS actual_total_time_min,
        CAST(d.drop_ts <= o.promised_ts AS INTEGER) AS is_on_time_flag, c.cancel_reason_code, c.cancel_actor
        FROM ow_orders o LEFT JOIN ow_deliveries d USING (order_id) LEFT JOIN ow_cancels c USING (order_id)"""),
    "ew": ((), f"SELECT *, {_K} AS k FROM events"),
    "ew_cities": ((), "SELECT c_custkey AS user_id, n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    "live_orders": (("ew", "ew_cities"), """SELECT event_id AS order_id, user_id AS customer_id, city, ts AS created_ts, value AS order_value,
        CASE WHEN k < 75 THEN 'success' WHEN k < 90 THEN 'cancel' ELSE 'fail' END AS order_status, CAST(ts AS DATE) AS order_date,
        CAST(hour(ts) AS INTEGER) AS order_hour FROM ew JOIN ew_cities USING (user_id) WHERE event_type = 'purchase'"""),
    "live_deliveries": (("ew",), """SELECT event_id AS delivery_id, user_id AS rider_id, CAST(ts AS DATE) AS delivery_date,
        value / 10 AS distance_km_actual, CAST(k < 80 AS INTEGER) AS is_on_time_flag, value AS total_delivery_time_min
        FROM ew WHERE event_type = 'click'"""),
    "live_shifts": (("ew", "ew_cities"), """SELECT event_id AS shift_id, user_id AS rider_id, city, ts AS shift_start_ts, ts AS actual_login_ts,
        ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS actual_logout_ts, value / 60 AS scheduled_hours, k % 2 = 1 AS late_start_flag,
        k % 3 = 1 AS overtime_flag FROM ew JOIN ew_cities USING (user_id) WHERE event_type = 'signup'"""),
    "live_support": (("ew",), """SELECT event_id AS ticket_id, user_id, ts AS created_ts, CAST(1 + k % 5 AS INTEGER) AS csat_score,
        CASE WHEN k < 30 THEN 'refund' ELSE 'late' END AS issue_category, value AS compensation_amount FROM ew WHERE event_type = 'error'"""),
    "live_pings": (("ew",), """SELECT event_id AS ping_id, user_id AS rider_id, k AS delivery_id, CAST(trunc(value) AS INTEGER) AS speed_kmh,
        k AS battery_level, ts AS ping_ts FROM ew WHERE event_type = 'view'"""),
    "rider_daily": (("live_shifts", "live_deliveries"), f"""SELECT s.rider_id, d.delivery_date, s.scheduled_hours,
        date_diff('second', s.actual_login_ts, s.actual_logout_ts) / 3600.0::DOUBLE AS actual_online_hours,
        d.total_completed_deliveries, d.total_km_driven,
        d.total_completed_deliveries / NULLIF(date_diff('second', s.actual_login_ts, s.actual_logout_ts) / 3600.0::DOUBLE, 0) AS deliveries_per_hour,
        d.on_time / d.total_completed_deliveries::DOUBLE AS on_time_rate FROM live_shifts s JOIN (
          SELECT rider_id, delivery_date, {n('delivery_id')} AS total_completed_deliveries, SUM(is_on_time_flag) AS on_time,
          {money('distance_km_actual', 4)} AS total_km_driven FROM live_deliveries GROUP BY ALL) d
        ON s.rider_id = d.rider_id AND CAST(s.shift_start_ts AS DATE) = d.delivery_date"""),
    "customers": ((), f"""SELECT c_custkey AS id, CAST(1940 + c_custkey % 60 AS INTEGER) AS birth_year, c_mktsegment AS education,
        CASE c_custkey % 3 WHEN 0 THEN 'Single' WHEN 1 THEN 'Couple' ELSE 'Family' END AS household,
        CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS income, CAST(c_custkey % 3 AS INTEGER) AS kids, CAST(c_custkey % 2 AS INTEGER) AS teens,
        b.* EXCLUDE (o_custkey), COALESCE(spend_economy, 0) AS spend_economy, COALESCE(spend_large, 0) AS spend_large,
        COALESCE(spend_medium, 0) AS spend_medium, COALESCE(spend_promo, 0) AS spend_promo, COALESCE(spend_small, 0) AS spend_small,
        COALESCE(spend_standard, 0) AS spend_standard FROM customer LEFT JOIN (
          SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS customer_since,
          CAST(DATE '2002-01-01' - CAST(MAX(o_orderdate) AS DATE) AS INTEGER) AS recency_days,
          {count_if("o_orderpriority = '1-URGENT'")} AS web_purchases, {count_if("o_orderpriority = '2-HIGH'")} AS store_purchases,
          {count_if("o_orderpriority = '3-MEDIUM'")} AS catalog_purchases, {count_if("o_orderpriority = '4-NOT SPECIFIED'")} AS web_visits,
          {count_if("o_orderpriority = '5-LOW'")} AS deals FROM orders GROUP BY 1) b ON b.o_custkey = c_custkey
        LEFT JOIN (SELECT o_custkey, {_SPEND} FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
          GROUP BY 1) s ON s.o_custkey = c_custkey"""),
    "subs": ((), f"""SELECT user_id, platform, age_group, city_tier, subscription_plan, new_subscription_plan, subscription_date, plan_change_date,
        CASE WHEN c_acctbal <= 5000 THEN last_order END AS last_active_date,
        CAST(CASE WHEN c_acctbal <= 5000 THEN last_order END IS NOT NULL AS INTEGER) AS inactivity_flag,
        CASE subscription_plan WHEN 'Basic' THEN 69.0 WHEN 'VIP' THEN 159.0 WHEN 'Premium' THEN CASE platform WHEN 'A' THEN 129.0 ELSE 359.0 END
          ELSE 0.0 END::DOUBLE AS plan_price FROM (
        SELECT c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS platform,
        CASE (c_custkey // 2) % 4 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' ELSE '45+' END AS age_group,
        'Tier ' || CAST(1 + c_nationkey % 3 AS INTEGER) AS city_tier, {_PLAN.format(2)} AS subscription_plan,
        {_PLAN.format(7)} AS new_subscription_plan, c_acctbal FROM customer) p LEFT JOIN (
        SELECT o_custkey, MAX(CASE WHEN r = 1 THEN d END) AS subscription_date, MAX(CASE WHEN r = 2 THEN d END) AS plan_change_date, MAX(d) AS last_order
        FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS r
          FROM orders) GROUP BY 1) o ON o.o_custkey = p.user_id"""),
    "engagement": (("subs",), f"""SELECT * FROM (SELECT user_id, CASE event_type WHEN 'click' THEN 'Mobile' WHEN 'view' THEN 'TV' WHEN 'purchase' THEN 'Laptop'
        WHEN 'signup' THEN 'Tablet' ELSE 'Web' END AS device_type, {money('value')} AS watch_mins FROM events GROUP BY 1, 2) JOIN subs USING (user_id)"""),
    "viewers": (("subs",), f"""SELECT s.*, COALESCE(w.watch_mins, 0.0) AS watch_mins FROM subs s LEFT JOIN (
        SELECT user_id, {money('value')} AS watch_mins FROM events GROUP BY 1) w USING (user_id)"""),
    "matches": ((), """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS season, r_name AS venue,
        h.n_name AS team1, a.n_name AS team2, CASE o_orderstatus WHEN 'F' THEN h.n_name WHEN 'O' THEN a.n_name END AS winner,
        CASE WHEN o_orderkey % 2 = 0 THEN h.n_name ELSE a.n_name END AS toss_winner, o_orderpriority AS toss_decision,
        CASE o_orderstatus WHEN 'F' THEN 'runs' WHEN 'O' THEN 'wickets' END AS result, CAST(o_orderkey % 150 + 1 AS INTEGER) AS result_margin,
        'U' || (o_orderkey % 20) AS umpire1, 'U' || (o_orderkey % 23) AS umpire2, 'P' || (o_custkey % 50) AS player_of_match
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation h ON c_nationkey = h.n_nationkey JOIN region ON h.n_regionkey = r_regionkey
        JOIN nation a ON a.n_nationkey = (c_nationkey + 1 + o_orderkey % 24) % 25"""),
    "balls": (("matches",), """SELECT l_orderkey AS id, CAST(1 + l_linenumber % 2 AS INTEGER) AS inning, CAST(l_quantity AS INTEGER) % 20 AS over,
        l_suppkey AS batsman, l_partkey % 50 AS bowler, l_linenumber AS batsman_runs, l_linenumber + CAST(l_returnflag = 'R' AS INTEGER) AS total_runs,
        CAST(l_returnflag = 'A' AS INTEGER) AS is_wicket, CASE WHEN l_linenumber % 2 = 0 THEN team1 ELSE team2 END AS batting_team,
        CASE WHEN l_linenumber % 2 = 0 THEN team2 ELSE team1 END AS bowling_team FROM lineitem JOIN matches ON l_orderkey = id"""),
    "innings": (("balls",), f"""SELECT id, inning, batting_team, bowling_team, {total('total_runs')} AS runs, {total('is_wicket')} AS wickets
        FROM balls GROUP BY ALL"""),
    "vehicles": ((), """SELECT n_name AS county, s_name AS city, p_brand AS make, p_name AS model, CAST(year(l_shipdate) AS INTEGER) AS model_year,
        CASE WHEN l_linestatus = 'F' THEN 'BEV' ELSE 'PHEV' END AS ev_type,
        CASE l_returnflag WHEN 'A' THEN 'Eligible' WHEN 'N' THEN 'Unknown' ELSE 'Not eligible' END AS cafv, p_size AS electric_range,
        CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE p_retailprice END AS base_msrp, p_type || '||' || p_brand AS electric_utility,
        l_suppkey AS census_tract FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey"""),
    "runs": ((), """SELECT l_suppkey AS machine, CAST(l_linenumber % 3 AS INTEGER) AS shift, 60 * l_quantity AS planned_min,
        60 * l_quantity * (1 - l_tax) AS run_min, 1 / (1 + l_discount) AS ideal_min, l_quantity AS units,
        CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END AS rejects, 60 * (1 - l_tax) AS cycle_min FROM lineitem"""),
    "stops": (("ew",), """SELECT user_id AS machine, value AS minutes,
        CASE k % 3 WHEN 0 THEN 'planned' WHEN 1 THEN 'unplanned' ELSE 'minor' END AS category FROM ew WHERE event_type = 'error'"""),
}


def sql(body: str, *views: str, **extra: str) -> str:
    """``body`` with the named views (and what they need) and ad-hoc ``extra`` views as a WITH clause."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for dep in VIEWS[name][0]:
            need(dep)
        if name not in wanted:
            wanted.append(name)

    for v in views:
        need(v)
    parts = [f"{v} AS ({VIEWS[v][1]})" for v in wanted] + [f"{k} AS ({q})" for k, q in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
