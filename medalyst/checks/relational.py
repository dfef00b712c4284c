"""P, J, A, W, T, R and X: projections, joins, aggregations, windows, sorting, reshaping, scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import count_if, half_even, half_up, money, money_avg, n, sql, total
from medalyst.checks.registry import query
from medalyst.functions import columns as c
from medalyst.operators import cleaning, dedupe, ordered, quantiles, relational, reshape

# --- projections and cleaning ---------------------------------------------------


@query("p01_contract_projection", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query("p02_renamed_columns", "SELECT c_custkey AS customer_id, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def _(t):
    mapping = {"c_custkey": "customer_id", "c_acctbal": "balance", "c_mktsegment": "segment"}
    return t.customer.select(*mapping).withColumnsRenamed(mapping)


@query("p03_dropped_columns", "SELECT * EXCLUDE (p_name, p_size) FROM part")
def _(t):
    return t.part.drop("p_name", "p_size")


@query("p04_typed_casts", """SELECT l_orderkey, CAST(l_orderkey AS VARCHAR) AS order_text, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_shipdate AS DATE) AS ship_date, l_returnflag = 'R' AS returned FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", F.col("l_orderkey").cast("string").alias("order_text"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").cast("date").alias("ship_date"), (F.col("l_returnflag") == "R").alias("returned"))


@query("p05_coerced_values", """SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS number,
    TRY_CAST(CASE WHEN event_id % 4 = 0 THEN 'unknown' ELSE '2024-01-' || lpad(CAST(1 + event_id % 28 AS VARCHAR), 2, '0') END AS DATE) AS day FROM events""")
def _(t):
    dirty = t.events.selectExpr(
        "event_id", "IF(event_id % 3 = 0, 'n/a', string(user_id)) AS number",
        "IF(event_id % 4 = 0, 'unknown', concat('2024-01-', lpad(string(1 + event_id % 28), 2, '0'))) AS day")
    return cleaning.coerced(dirty, {"number": "bigint", "day": "date"})


@query("p06_case_branches", """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS size,
    CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END AS done FROM orders""")
def _(t):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return t.orders.select("o_orderkey", c.ladder([(price > 300000, "high"), (price > 100000, "mid")], "low").alias("size"),
                           c.ladder([(status == "F", 1), (status == "O", 0)]).alias("done"))


@query("p07_ordered_labels", """SELECT event_id, CASE WHEN value > 100 AND event_type IN ('view', 'purchase') THEN 'heavy multi-device'
    WHEN value <= 20 AND event_type = 'click' THEN 'light mobile' WHEN value <= 50 THEN 'casual' ELSE 'other' END AS label FROM events""")
def _(t):
    v, k = F.col("value"), F.col("event_type")
    rules = [((v > 100) & k.isin("view", "purchase"), "heavy multi-device"), ((v <= 20) & (k == "click"), "light mobile"), (v <= 50, "casual")]
    return t.events.select("event_id", c.ladder(rules, "other").alias("label"))


@query("p08_binary_conditional", "SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN l_extendedprice * 0.5 ELSE l_extendedprice END AS kept FROM lineitem")
def _(t):
    price = F.col("l_extendedprice")
    return t.lineitem.select("l_orderkey", F.when(F.col("l_returnflag") == "R", price * 0.5).otherwise(price).alias("kept"))


@query("p09_dictionary_lookup", """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END AS rank
    FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", c.lookup("o_orderpriority", {"1-URGENT": 3, "2-HIGH": 2, "3-MEDIUM": 1}, 0).alias("rank"))


@query("p10_two_key_price_lookup", sql("SELECT user_id, platform, subscription_plan, plan_price FROM subs", "subs"))
def _(t):
    from medalyst.plans.subscribers import PLAN_PRICES
    people = b.subscribers(t).select("user_id", "platform", "subscription_plan")
    prices = t.spark.createDataFrame([(p, plan, float(v)) for (p, plan), v in PLAN_PRICES.items()],
                                     "platform string, subscription_plan string, plan_price double")
    return people.join(prices, ["platform", "subscription_plan"], "left").fillna(0.0, ["plan_price"])


@query("p11_predicates", """SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND NOT o_orderstatus IN ('P')
    AND o_orderdate IS NOT NULL AND (o_orderpriority = '1-URGENT' OR o_custkey < 700)""")
def _(t):
    return t.orders.where(F.col("o_totalprice").between(1000, 200000) & ~F.col("o_orderstatus").isin("P") & F.col("o_orderdate").isNotNull()
                          ).where("o_orderpriority = '1-URGENT' OR o_custkey < 700").select("o_orderkey")


@query("p12_filled_nulls", sql("""SELECT user_id, COALESCE(CAST(last_active_date AS VARCHAR), 'Active') AS last_seen,
    COALESCE(last_active_date, DATE '2002-01-01') AS closed FROM subs""", "subs"))
def _(t):
    s = b.subscribers(t)
    return s.select("user_id", F.coalesce(F.col("last_active_date").cast("string"), F.lit("Active")).alias("last_seen"),
                    F.coalesce("last_active_date", F.lit("2002-01-01").cast("date")).alias("closed"))


@query("p13_complete_rows", sql("SELECT id, income FROM customers WHERE income IS NOT NULL AND customer_since IS NOT NULL", "customers"))
def _(t):
    return b.customers(t).dropna(subset=["income", "customer_since"]).select("id", "income")


@query("p14_first_per_key", """SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand
    ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r = 1""")
def _(t):
    return dedupe.top_per_key(t.part, ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")]).select("p_brand", "p_partkey", "p_retailprice")


@query("p15_clipped_values", "SELECT c_custkey, LEAST(GREATEST(c_acctbal, 0), 5000) AS bounded, GREATEST(c_acctbal, 0) AS floored FROM customer")
def _(t):
    return t.customer.select("c_custkey", c.clip("c_acctbal", 0.0, 5000.0).alias("bounded"), c.clip("c_acctbal", low=0.0).alias("floored"))


@query("p16_row_totals", sql(f"""SELECT id, {half_up('COALESCE(income, 0) + spend_promo + spend_small')} AS money,
    web_purchases + store_purchases + catalog_purchases AS purchases FROM customers""", "customers"))
def _(t):
    return b.customers(t).select("id", F.round(c.row_total(["income", "spend_promo", "spend_small"]), 2).alias("money"),
                                 c.row_total(b.CHANNELS).alias("purchases"))


@query("p17_one_hot", sql("""SELECT user_id, CAST(age_group = '25-34' AS INTEGER) AS "age_25-34", CAST(age_group = '35-44' AS INTEGER) AS "age_35-44",
    CAST(age_group = '45+' AS INTEGER) AS "age_45+" FROM subs""", "subs"))
def _(t):
    return b.subscribers(t).select("user_id", *c.one_hot("age_group", ["18-24", "25-34", "35-44", "45+"], "age"))


@query("p18_ordinal_codes", """SELECT o_orderkey, CAST(DENSE_RANK() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS code FROM orders""")
def _(t):
    from pyspark.ml.feature import StringIndexer
    indexer = StringIndexer(inputCol="o_orderpriority", outputCol="code", stringOrderType="alphabetAsc").fit(t.orders)
    return indexer.transform(t.orders).select("o_orderkey", "code")


@query("p19_columns_identical", f"SELECT {n()} = COUNT(*) FILTER (WHERE l_orderkey IS NOT DISTINCT FROM l_partkey) AS identical, "
       f"{count_if('l_orderkey IS DISTINCT FROM l_partkey')} AS n_different FROM lineitem")
def _(t):
    return cleaning.columns_identical(t.lineitem, "l_orderkey", "l_partkey")


_FENCE = """SELECT quantile_cont(o_totalprice, 0.25) - {r} * (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)) AS lo,
    quantile_cont(o_totalprice, 0.75) + {r} * (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)) AS hi FROM orders"""


@query("p21_iqr_filter", f"SELECT o_orderkey, o_totalprice FROM orders, ({_FENCE.format(r=0.4)}) f WHERE o_totalprice BETWEEN lo AND hi")
def _(t):
    # a tighter reach than the usual 1.5, so that the fences cut something in evenly spread prices
    return quantiles.within_fences(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", reach=0.4)


@query("p22_mean_imputed", f"""SELECT c_custkey, {half_up('COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, (SELECT AVG(c_acctbal) FROM customer WHERE c_acctbal >= 0))', 6)}
    AS balance FROM customer""")
def _(t):
    gaps = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    return cleaning.fill_with_mean(gaps, ["balance"]).withColumn("balance", F.round("balance", 6))


@query("p23_single_column_neighbour_imputed", sql(f"""SELECT id, {half_up('COALESCE(income, (SELECT AVG(income) FROM customers))', 6)} AS income
    FROM customers""", "customers"))
def _(t):
    # with one column a missing row has no neighbours to rank, so the fill is the column mean
    return cleaning.fill_with_mean(b.customers(t).select("id", "income"), ["income"]).withColumn("income", F.round("income", 6))


@query("p24_median_imputed", sql(f"""SELECT id, {half_up('COALESCE(income, (SELECT quantile_cont(income, 0.5) FROM customers))', 6)} AS income
    FROM customers""", "customers"))
def _(t):
    return cleaning.fill_with_median(b.customers(t).select("id", "income"), ["income"]).withColumn("income", F.round("income", 6))


@query("p25_min_max_scaled", f"""SELECT o_orderkey, {half_up('(o_totalprice - lo) / NULLIF(hi - lo, 0)', 9)} AS scaled FROM orders,
    (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi FROM orders)""")
def _(t):
    return cleaning.min_max_scaled(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "scaled").select(
        "o_orderkey", F.round("scaled", 9).alias("scaled"))


def _null_share(col):
    return f"SELECT '{col}' AS column_name, {half_up(f'COUNT(*) FILTER (WHERE {col} IS NULL) * 100.0::DOUBLE / COUNT(*)')} AS null_pct FROM subs"


_SUB_COLS = ["user_id", "last_active_date", "plan_change_date", "age_group"]


@query("p26_null_profile", sql(" UNION ALL ".join(_null_share(x) for x in _SUB_COLS), "subs"))
def _(t):
    return cleaning.null_profile(b.subscribers(t).select(*_SUB_COLS))


def _profile(col):
    q = [f"{half_up(f'quantile_cont({col}, {p})', 4)} AS {a}" for p, a in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    return (f"SELECT '{col}' AS column_name, {n(col)} AS n, {half_up(f'AVG({col})', 4)} AS mean, {half_up(f'STDDEV_SAMP({col})', 4)} AS std, "
            f"CAST(MIN({col}) AS DOUBLE) AS min, CAST(MAX({col}) AS DOUBLE) AS max, {', '.join(q)} FROM lineitem")


@query("p27_column_profile", " UNION ALL ".join(_profile(x) for x in ("l_quantity", "l_extendedprice", "l_discount")))
def _(t):
    return cleaning.numeric_profile(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])


@query("p28_distinct_counts", f"SELECT {n('DISTINCT o_custkey')} AS customers, {n('DISTINCT o_orderpriority')} AS priorities FROM orders")
def _(t):
    return t.orders.agg(F.countDistinct("o_custkey").alias("customers"), F.countDistinct("o_orderpriority").alias("priorities"))


@query("p28_distinct_values", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


# --- joins ------------------------------------------------------------------------

@query("j01_left_anti_quarantine", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def _(t):
    return relational.without_keys(t.orders.select("o_orderkey", "o_custkey"),
                                   t.lineitem.where("l_quantity > 49").selectExpr("l_orderkey AS o_orderkey"), ["o_orderkey"])


@query("j02_left_enrichment", """SELECT o_orderkey, l_linenumber, l_quantity, c_name FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey""")
def _(t):
    return t.orders.join(t.lineitem, F.expr("o_orderkey = l_orderkey"), "left").join(t.customer, F.expr("o_custkey = c_custkey"), "left").select(
        "o_orderkey", "l_linenumber", "l_quantity", "c_name")


@query("j03_inner_join", "SELECT l_orderkey, l_linenumber, p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey")
def _(t):
    return t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).select("l_orderkey", "l_linenumber", "p_brand", "p_type")


@query("j04_derived_key_join", sql(f"""SELECT rider_id, delivery_date, shifts, deliveries FROM
    (SELECT rider_id, CAST(shift_start_ts AS DATE) AS delivery_date, {n()} AS shifts FROM live_shifts GROUP BY 1, 2)
    JOIN (SELECT rider_id, delivery_date, {n()} AS deliveries FROM live_deliveries GROUP BY 1, 2) USING (rider_id, delivery_date)""", "live_shifts", "live_deliveries"))
def _(t):
    # both sides are one row per rider and day before they meet
    days = ["rider_id", "delivery_date"]
    shifts = b.live_shifts(t).withColumn("delivery_date", F.to_date("shift_start_ts")).groupBy(*days).agg(F.count(F.lit(1)).alias("shifts"))
    return shifts.join(b.live_deliveries(t).groupBy(*days).agg(F.count(F.lit(1)).alias("deliveries")), days)


@query("j05_renamed_multi_key_join", sql(f"""SELECT o.city, o.order_date, o.order_hour, o.orders, s.logins FROM
    (SELECT city, order_date, order_hour, {n()} AS orders FROM live_orders GROUP BY 1, 2, 3) o
    JOIN (SELECT city, CAST(actual_login_ts AS DATE) AS d, CAST(hour(actual_login_ts) AS INTEGER) AS h, {n()} AS logins FROM live_shifts GROUP BY 1, 2, 3) s
    ON o.city = s.city AND o.order_date = s.d AND o.order_hour = s.h""", "live_orders", "live_shifts"))
def _(t):
    # both sides are one row per city and hour before they meet
    hours = ["city", "order_date", "order_hour"]
    named = b.live_shifts(t).withColumns({"order_date": F.to_date("actual_login_ts"), "order_hour": F.hour("actual_login_ts")})
    return b.live_orders(t).groupBy(*hours).agg(F.count(F.lit(1)).alias("orders")).join(
        named.groupBy(*hours).agg(F.count(F.lit(1)).alias("logins")), hours)


@query("j06_join_of_aggregates", f"""SELECT k AS supplier, a.n AS lines, b.value AS late_value FROM (SELECT l_suppkey AS k, {n()} AS n FROM lineitem GROUP BY 1) a
    JOIN (SELECT l_suppkey AS k, {money('l_extendedprice')} AS value FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b USING (k)""")
def _(t):
    lines = t.lineitem.groupBy(F.col("l_suppkey").alias("supplier")).agg(F.count(F.lit(1)).alias("lines"))
    late = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_suppkey").alias("supplier")).agg(c.exact_sum("l_extendedprice").alias("late_value"))
    return lines.join(late, "supplier")


@query("j07_aggregate_then_join", f"""SELECT o_orderkey, o_totalprice, COALESCE(q.n, 0) AS lines, COALESCE(q.s, 0.0) AS line_total FROM orders LEFT JOIN (
    SELECT l_orderkey, {n()} AS n, {money('l_extendedprice')} AS s FROM lineitem GROUP BY 1) q ON o_orderkey = l_orderkey""")
def _(t):
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"),
                                                                               c.exact_sum("l_extendedprice").alias("line_total"))
    return t.orders.select("o_orderkey", "o_totalprice").join(per_order, "o_orderkey", "left").fillna(0, ["lines"]).fillna(0.0, ["line_total"])


@query("j09_null_matching_join", sql(f"""SELECT l.winner, {n()} AS pairs FROM (SELECT season, winner FROM matches) l JOIN (
    SELECT DISTINCT winner FROM matches) r ON l.winner IS NOT DISTINCT FROM r.winner GROUP BY 1""", "matches"))
def _(t):
    m = b.matches(t).select("season", "winner")
    return relational.null_safe_join(m, m.select("winner").distinct(), ["winner"]).groupBy("winner").agg(F.count(F.lit(1)).alias("pairs"))


@query("j10_group_mean_on_detail", f"""SELECT event_id, {half_up('value - m', 4)} AS above_mean FROM events JOIN (
    SELECT event_type, {money_avg('value')} AS m FROM events GROUP BY 1) USING (event_type)""")
def _(t):
    detail = relational.with_group_stat(t.events, ["event_type"], {"m": c.exact_avg("value")})
    return detail.select("event_id", F.round(F.col("value") - F.col("m"), 4).alias("above_mean"))


@query("j11_semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE value > 50)")
def _(t):
    heavy = t.events.where("value > 50").selectExpr("user_id AS c_custkey")
    return t.customer.join(heavy, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("j12_dense_range_join", """SELECT p_brand, CAST(size AS BIGINT) AS size, COALESCE(q.n, 0) AS parts FROM (
    SELECT p_brand, UNNEST(range(0, MAX(p_size) + 1)) AS size FROM part GROUP BY 1) g LEFT JOIN (
    SELECT p_brand, p_size AS size, CAST(COUNT(*) AS BIGINT) AS n FROM part GROUP BY ALL) q USING (p_brand, size)""")
def _(t):
    counts = t.part.groupBy("p_brand", F.col("p_size").alias("size")).agg(F.count(F.lit(1)).alias("parts"))
    return reshape.step_grid(counts, ["p_brand"], "size", "parts")


# --- aggregations --------------------------------------------------------------------

@query("a01_grouped_aggregates", f"""SELECT l_returnflag, l_linestatus, {money('l_quantity')} AS sum_qty, {money('l_extendedprice')} AS sum_price,
    {half_up(money_avg('l_quantity'), 6)} AS avg_qty, {n()} AS n, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY 1, 2""")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        c.exact_sum("l_quantity").alias("sum_qty"), c.exact_sum("l_extendedprice").alias("sum_price"),
        F.round(c.exact_avg("l_quantity"), 6).alias("avg_qty"), F.count(F.lit(1)).alias("n"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@query("a02_global_aggregate", f"SELECT {n()} AS n, {money('o_totalprice')} AS total, MIN(o_orderdate) AS first_day, MAX(o_orderdate) AS last_day FROM orders")
def _(t):
    return t.orders.agg(F.count(F.lit(1)).alias("n"), c.exact_sum("o_totalprice").alias("total"), F.min("o_orderdate").alias("first_day"),
                        F.max("o_orderdate").alias("last_day"))


@query("a03_conditional_counts", f"""SELECT {count_if("l_returnflag = 'R'")} AS returned, {count_if('l_quantity > 45')} AS bulky,
    {count_if('l_discount = 0')} AS full_price FROM lineitem""")
def _(t):
    return t.lineitem.agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if(F.col("l_quantity") > 45).alias("bulky"),
                          F.count_if(F.col("l_discount") == 0).alias("full_price"))


@query("a04_grouped_distinct", f"SELECT l_suppkey, {n('DISTINCT l_partkey')} AS parts FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"))


@query("a05_percentile_of_data", "SELECT event_type, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("event_type").agg(F.percentile_approx("value", 0.95, 1_000_000).alias("p95"))


@query("a06_exact_quantiles", f"""SELECT l_returnflag, {half_up('quantile_cont(l_extendedprice, 0.25)', 4)} AS q1, {half_up('quantile_cont(l_extendedprice, 0.9)', 4)} AS p90
    FROM lineitem GROUP BY 1""")
def _(t):
    q = quantiles.exact_quantiles(t.lineitem, "l_extendedprice", {"q1": 0.25, "p90": 0.9}, ["l_returnflag"])
    return q.select("l_returnflag", F.round("q1", 4).alias("q1"), F.round("p90", 4).alias("p90"))


@query("a07_median", f"SELECT c_mktsegment, {half_up('median(c_acctbal)', 4)} AS median_balance FROM customer GROUP BY 1")
def _(t):
    q = quantiles.exact_quantiles(t.customer, "c_acctbal", {"m": 0.5}, ["c_mktsegment"])
    return q.select("c_mktsegment", F.round("m", 4).alias("median_balance"))


@query("a08_sample_spread", f"SELECT event_type, {half_up('STDDEV_SAMP(value)', 4)} AS std, {half_up('VAR_SAMP(value)', 4)} AS var FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("event_type").agg(F.round(F.stddev_samp("value"), 4).alias("std"), F.round(F.var_samp("value"), 4).alias("var"))


@query("a09_aggregate_of_aggregate", f"""SELECT c_nationkey, {half_up('AVG(n)', 4)} AS avg_orders, MAX(n) AS max_orders FROM (
    SELECT o_custkey, {n()} AS n FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def _(t):
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per_customer.join(t.customer, F.expr("o_custkey = c_custkey")).groupBy("c_nationkey").agg(
        F.round(F.avg("n"), 4).alias("avg_orders"), F.max("n").alias("max_orders"))


@query("a10_value_counts", sql(f"SELECT winner, {n()} AS n FROM matches WHERE winner IS NOT NULL GROUP BY 1", "matches"))
def _(t):
    return relational.frequency(b.matches(t), ["winner"])


@query("a11_share_of_total", f"""SELECT l_returnflag, l_linestatus, {n()} AS n, {half_even('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (PARTITION BY l_returnflag)')} AS pct_in_flag,
    {half_even('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()')} AS pct_of_all FROM lineitem GROUP BY 1, 2""")
def _(t):
    counts = relational.frequency(t.lineitem, ["l_returnflag", "l_linestatus"])
    return relational.with_share(relational.with_share(counts, "n", "pct_in_flag", ["l_returnflag"]), "n", "pct_of_all")


@query("a12_duplicate_groups", f"SELECT l_orderkey, l_linenumber, {n()} AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def _(t):
    return dedupe.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("a13_arg_max_per_group", f"""SELECT n_name, p_brand, n FROM (SELECT n_name, p_brand, n, ROW_NUMBER() OVER (PARTITION BY n_name ORDER BY n DESC, p_brand) AS r FROM (
    SELECT n_name, p_brand, {n()} AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)) WHERE r = 1""")
def _(t):
    joined = (t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).join(t.supplier, F.expr("l_suppkey = s_suppkey"))
              .join(t.nation, F.expr("s_nationkey = n_nationkey")))
    return relational.leader_per_group(relational.frequency(joined, ["n_name", "p_brand"]), ["n_name"], "p_brand", "n")


@query("a14_global_arg_extremes", """SELECT arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS dearest, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest FROM orders""")
def _(t):
    by = F.struct("o_totalprice", "o_orderkey")
    return t.orders.agg(F.max_by("o_orderkey", by).alias("dearest"), F.min_by("o_orderkey", by).alias("cheapest"))


@query("a15_share_above_threshold", f"""SELECT event_type, {half_up('AVG(CAST(value >= 50 AS INTEGER)) * 100', 4)} AS pct_50, {half_up('AVG(CAST(value >= 100 AS INTEGER)) * 100', 4)} AS pct_100
    FROM events GROUP BY 1""")
def _(t):
    share = lambda limit: F.round(F.avg((F.col("value") >= limit).cast("int")) * 100, 4)
    return t.events.groupBy("event_type").agg(share(50).alias("pct_50"), share(100).alias("pct_100"))


@query("a16_counts_above_mean", f"""SELECT k AS supplier, n FROM (SELECT l_suppkey AS k, {n()} AS n FROM lineitem GROUP BY 1)
    WHERE n > (SELECT AVG(n) FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_suppkey))""")
def _(t):
    counts = t.lineitem.groupBy(F.col("l_suppkey").alias("supplier")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > counts.agg(F.avg("n")).scalar())


@query("a17_group_set_condition", "SELECT user_id FROM events GROUP BY 1 HAVING BOOL_OR(event_type = 'purchase') AND COUNT(DISTINCT event_type) > 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("bought"), F.countDistinct("event_type").alias("kinds")
                                           ).where("bought and kinds > 1").select("user_id")


@query("a18_named_aggregates", f"""SELECT p_type, {half_up('AVG(p_size)', 4)} AS size_mean, MIN(p_size) AS size_min, MAX(p_size) AS size_max,
    {half_up(money_avg('p_retailprice'), 4)} AS price_mean FROM part GROUP BY 1""")
def _(t):
    return t.part.groupBy("p_type").agg(F.round(F.avg("p_size"), 4).alias("size_mean"), F.min("p_size").alias("size_min"),
                                        F.max("p_size").alias("size_max"), F.round(c.exact_avg("p_retailprice"), 4).alias("price_mean"))


@query("a19_detail_and_overall", f"""SELECT COALESCE(g, 'Overall') AS l_returnflag, l_linestatus, lines, value FROM (
    SELECT l_returnflag AS g, l_linestatus, {n()} AS lines, {money('l_extendedprice')} AS value FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus)))""")
def _(t):
    return relational.detail_and_overall(t.lineitem, "l_returnflag", ["l_linestatus"],
                                         [F.count(F.lit(1)).alias("lines"), c.exact_sum("l_extendedprice").alias("value")])


# --- windows --------------------------------------------------------------------------

@query("w01_latest_per_key", """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1""")
def _(t):
    newest = dedupe.latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey", "l_suppkey", "l_extendedprice"])
    return newest.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")


@query("w02_lag_within_key", """SELECT event_id, LAG(value, 1, 0.0) OVER w AS prev_1, LAG(value, 2, 0.0) OVER w AS prev_2 FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    cols = t.events.select("event_id", "user_id", "ts", "value")
    return ordered.lagged(cols, {"prev_1": ("value", 1), "prev_2": ("value", 2)}, ["ts", "event_id"], ["user_id"], 0.0).select("event_id", "prev_1", "prev_2")


@query("w03_month_over_month", sql(f"""SELECT month, n, {half_even('COALESCE((n - LAG(n) OVER w) * 100.0::DOUBLE / LAG(n) OVER w, 0)')} AS change_pct FROM m
    WINDOW w AS (ORDER BY month)""", m=f"SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {n()} AS n FROM orders GROUP BY 1"))
def _(t):
    from medalyst.plans.subscribers import pct_change
    monthly = t.orders.groupBy(c.month_start("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return monthly.withColumn("change_pct", pct_change("n", ["month"]))


@query("w04_first_difference", sql("SELECT month, n, n - LAG(n) OVER (ORDER BY month) AS diff FROM m",
                                   m=f"SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {n()} AS n FROM orders GROUP BY 1"))
def _(t):
    monthly = t.orders.groupBy(c.month_start("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return monthly.withColumn("diff", F.col("n") - F.lag("n").over(Window.orderBy("month")))   # one row per month


@query("w05_group_transform", f"""SELECT event_id, m AS group_total, n AS group_size FROM events JOIN (
    SELECT event_type, {money('value')} AS m, {n()} AS n FROM events GROUP BY 1) USING (event_type)""")
def _(t):
    detail = relational.with_group_stat(t.events, ["event_type"], {"group_total": c.exact_sum("value"), "group_size": F.count(F.lit(1))})
    return detail.select("event_id", "group_total", "group_size")


@query("w06_rank_bins", """SELECT c_custkey, CAST(GREATEST(1, CEIL((rn - 1) * 5 / CAST(NULLIF(n - 1, 0) AS DOUBLE))) AS INTEGER) AS bin FROM (
    SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_acctbal, c_custkey) AS rn, COUNT(*) OVER () AS n FROM customer)""")
def _(t):
    return quantiles.with_rank_bins(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", ["c_custkey"], 5, "bin").select("c_custkey", "bin")


@query("w07_value_bins", """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity <= a THEN 5 WHEN l_quantity <= b THEN 4 WHEN l_quantity <= c THEN 3
    WHEN l_quantity <= d THEN 2 ELSE 1 END AS score FROM lineitem, (SELECT quantile_cont(l_quantity, 0.2) AS a, quantile_cont(l_quantity, 0.4) AS b,
    quantile_cont(l_quantity, 0.6) AS c, quantile_cont(l_quantity, 0.8) AS d FROM lineitem)""")
def _(t):
    return quantiles.with_value_bins(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", 5, [5, 4, 3, 2, 1], "score")


@query("w08_global_row_number", "SELECT event_id, ROW_NUMBER() OVER (ORDER BY value, event_id) AS row_no FROM events")
def _(t):
    return ordered.number_rows(t.events.select("event_id", "value"), ["value", "event_id"]).select("event_id", "row_no")


@query("w09_last_per_group", sql("SELECT season, arg_max(winner, (date, id)) AS champion FROM (SELECT season, COALESCE(winner, 'undecided') AS winner, date, id FROM matches) GROUP BY 1",
                                 "matches"))
def _(t):
    m = b.matches(t).withColumn("winner", F.coalesce("winner", F.lit("undecided")))
    return m.groupBy("season").agg(F.max_by("winner", F.struct("date", "id")).alias("champion"))


@query("w10_cumulative_sum", f"""SELECT event_id, {half_up('SUM(CAST(value AS DECIMAL(18,2))) OVER (ORDER BY ts, event_id)', 2)} AS running FROM events""")
def _(t):
    cols = t.events.select("event_id", "ts", F.col("value").cast("decimal(18,2)").alias("v"))
    run = ordered.running_total(cols, "v", ["ts", "event_id"])
    return run.select("event_id", F.col("running").cast("double").alias("running"))


# --- sort, limit, set operations, reshape --------------------------------------------------

@query("t01_sorted", "SELECT n_name, n_regionkey FROM nation ORDER BY n_regionkey DESC, n_name")
def _(t):
    return t.nation.select("n_name", "n_regionkey").orderBy(F.desc_nulls_last("n_regionkey"), F.asc_nulls_last("n_name"))


@query("t02_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).limit(20)


@query("t03_top_k_per_group", """SELECT c_nationkey, c_custkey, c_acctbal, r AS place FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS r
    FROM customer) WHERE r <= 3""")
def _(t):
    return dedupe.top_per_key(t.customer.select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"],
                              [F.desc("c_acctbal"), F.asc("c_custkey")], 3, rank_as="place")


@query("t04_emptiness_probe", "SELECT NOT EXISTS (SELECT 1 FROM lineitem WHERE l_quantity > 50) AS none_above, NOT EXISTS (SELECT 1 FROM lineitem WHERE l_quantity > 49) AS none_at_top")
def _(t):
    probes = [(t.lineitem.where("l_quantity > 50").isEmpty(), t.lineitem.where("l_quantity > 49").isEmpty())]
    return t.spark.createDataFrame(probes, "none_above boolean, none_at_top boolean")


@query("r01_tagged_union", """SELECT o_orderkey AS id, o_totalprice AS amount, NULL AS kind, 'order' AS source FROM orders
    UNION ALL SELECT event_id, value, event_type, 'event' FROM events""")
def _(t):
    return reshape.tagged_union({"order": t.orders.selectExpr("o_orderkey AS id", "o_totalprice AS amount"),
                                 "event": t.events.selectExpr("event_id AS id", "value AS amount", "event_type AS kind")}, "source")


@query("r02_key_overlap", """SELECT COALESCE(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'second only' WHEN b.k IS NULL THEN 'first only' ELSE 'both' END AS found_in
    FROM (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0) a FULL JOIN (SELECT DISTINCT user_id AS k FROM events) b ON a.k = b.k""")
def _(t):
    return relational.key_overlap(t.customer.where("c_acctbal > 0").selectExpr("c_custkey AS k"), t.events.selectExpr("user_id AS k"), "k")


@query("r03_pivot", f"""SELECT l_returnflag, COALESCE({money("CASE WHEN l_linestatus = 'F' THEN l_quantity END")}, 0) AS "F",
    COALESCE({money("CASE WHEN l_linestatus = 'O' THEN l_quantity END")}, 0) AS "O" FROM lineitem GROUP BY 1""")
def _(t):
    return reshape.rows_to_columns(t.lineitem, ["l_returnflag"], "l_linestatus", ["F", "O"], c.exact_sum("l_quantity"), fill=0.0)


@query("r04_unpivot", """SELECT c_custkey, 'c_acctbal' AS measure, c_acctbal AS amount FROM customer UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS DOUBLE) FROM customer""")
def _(t):
    wide = t.customer.select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    return reshape.columns_to_rows(wide, ["c_acctbal", "nation"], "measure", "amount", keep=["c_custkey"])


@query("r05_month_grid", sql("""SELECT k AS customer, month, COALESCE(q.n, 0) AS orders FROM (
    SELECT k, CAST(UNNEST(generate_series(MIN(month)::TIMESTAMP, MAX(month)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS month FROM m GROUP BY 1) g LEFT JOIN m q USING (k, month)""",
                             m=f"SELECT o_custkey AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {n()} AS n FROM orders GROUP BY ALL"))
def _(t):
    monthly = t.orders.groupBy(F.col("o_custkey").alias("customer"), c.month_start("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    return reshape.month_grid(monthly, ["customer"], "month", "orders")


@query("r06_crosstab_share", sql(f"""SELECT age_group, {', '.join(half_up(f"x.{k} * 100.0::DOUBLE / NULLIF(y.{k}, 0)") + f" AS {k}" for k in ("t1", "t2", "t3"))}
    FROM (SELECT age_group, {', '.join(count_if(f"city_tier = 'Tier {i}'") + f" AS t{i}" for i in (1, 2, 3))} FROM subs WHERE plan_price > 0 GROUP BY 1) x
    JOIN (SELECT age_group, {', '.join(count_if(f"city_tier = 'Tier {i}'") + f" AS t{i}" for i in (1, 2, 3))} FROM subs GROUP BY 1) y USING (age_group)""", "subs"))
def _(t):
    s = b.subscribers(t).withColumn("tier", F.concat(F.lit("t"), F.substring("city_tier", 6, 1)))
    grid = lambda df: reshape.rows_to_columns(df, ["age_group"], "tier", ["t1", "t2", "t3"], F.count(F.lit(1)), fill=0)
    part, whole = grid(s.where("plan_price > 0")), grid(s).withColumnsRenamed({k: f"{k}_all" for k in ("t1", "t2", "t3")})
    return part.join(whole, "age_group").select("age_group", *[c.pct(k, f"{k}_all").alias(k) for k in ("t1", "t2", "t3")])


@query("r07_totals_transposed", f"""SELECT 'l_quantity' AS name, {money('l_quantity')} AS total FROM lineitem UNION ALL SELECT 'l_extendedprice', {money('l_extendedprice')} FROM lineitem""")
def _(t):
    totals = t.lineitem.agg(c.exact_sum("l_quantity").alias("l_quantity"), c.exact_sum("l_extendedprice").alias("l_extendedprice"))
    return reshape.columns_to_rows(totals, ["l_quantity", "l_extendedprice"], "name", "total")


# --- scalar functions --------------------------------------------------------------------

@query("x01_text_functions", """SELECT p_partkey, UPPER(TRIM(p_name)) AS up, LOWER(p_brand) AS low, REPLACE(p_brand, '#', ' ') AS spaced, p_type || '/' || p_brand AS joined,
    UPPER(p_name[1]) || p_name[2:instr(p_name, ' ')] || UPPER(p_name[instr(p_name, ' ') + 1]) || p_name[instr(p_name, ' ') + 2:] AS title FROM part""")
def _(t):
    return t.part.select("p_partkey", F.upper(F.trim("p_name")).alias("up"), F.lower("p_brand").alias("low"), F.replace("p_brand", F.lit("#"), F.lit(" ")).alias("spaced"),
                         F.concat("p_type", F.lit("/"), "p_brand").alias("joined"), F.initcap("p_name").alias("title"))


@query("x02_wkt_point", """SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_nationkey AS DOUBLE) - 12.5 END AS lon,
    CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey % 90 AS DOUBLE) END AS lat FROM customer""")
def _(t):
    text = F.expr("IF(c_custkey % 10 = 0, 'POINT EMPTY', concat('POINT (', double(c_nationkey) - 12.5, ' ', c_custkey % 90, ')'))")
    lon, lat = c.wkt_point("wkt")
    return t.customer.select("c_custkey", text.alias("wkt")).select("c_custkey", lon.alias("lon"), lat.alias("lat"))


@query("x03_multi_value_text", """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'Unknown' ELSE upper(p_type[1]) || lower(p_type[2:]) || ', Brand#' || replace(p_brand, 'Brand#', '') END AS utility FROM part""")
def _(t):
    raw = F.expr("IF(p_partkey % 7 = 0, NULL, concat(p_type, IF(p_partkey % 2 = 0, '||', '|'), p_brand))")
    return t.part.select("p_partkey", c.tidy_multi_value(raw).alias("utility"))


@query("x04_date_parts", """SELECT event_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hr, dayname(ts) AS day_name, CAST(year(ts) AS INTEGER) AS yr,
    CAST(month(ts) AS INTEGER) AS mo, CAST(quarter(ts) AS INTEGER) AS qtr, CAST(date_trunc('month', ts) AS DATE) AS month_start FROM events""")
def _(t):
    return t.events.select("event_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hr"), F.date_format("ts", "EEEE").alias("day_name"),
                           F.year("ts").alias("yr"), F.month("ts").alias("mo"), F.quarter("ts").alias("qtr"), c.month_start("ts").alias("month_start"))


@query("x05_durations", f"""SELECT l_orderkey, l_linenumber, {half_up("date_diff('second', o_orderdate, l_shipdate) / 60.0::DOUBLE", 4)} AS minutes,
    {half_up("date_diff('second', o_orderdate, l_shipdate) / 3600.0::DOUBLE", 4)} AS hours, CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    j = t.lineitem.join(t.orders, F.expr("l_orderkey = o_orderkey"))
    return j.select("l_orderkey", "l_linenumber", F.round(c.minutes_between("o_orderdate", "l_shipdate"), 4).alias("minutes"),
                    F.round(c.hours_between("o_orderdate", "l_shipdate"), 4).alias("hours"), F.datediff("l_shipdate", "o_orderdate").alias("days"))


@query("x06_months_between", f"""SELECT o_orderkey, CAST((2002 - year(o_orderdate)) * 12 + 1 - month(o_orderdate) AS INTEGER) AS calendar_months,
    (DATE '2002-01-01' - CAST(o_orderdate AS DATE)) // 30 AS thirty_day_months, {half_even("(DATE '2002-01-01' - CAST(o_orderdate AS DATE)) / 30.0::DOUBLE")} AS share_of_months FROM orders""")
def _(t):
    end = F.lit("2002-01-01").cast("date")
    return t.orders.select("o_orderkey", c.calendar_months("o_orderdate", end).alias("calendar_months"), c.thirty_day_months("o_orderdate", end).alias("thirty_day_months"),
                           F.bround(F.datediff(end, "o_orderdate") / 30, 2).alias("share_of_months"))


@query("x07_parsed_timestamp", "SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS parsed FROM orders")
def _(t):
    text = F.date_format("o_orderdate", "yyyyMMddHHmmss")
    return t.orders.select("o_orderkey", F.to_timestamp_ntz(text, F.lit("yyyyMMddHHmmss")).alias("parsed"))


@query("x08_numeric_functions", f"""SELECT l_orderkey, l_linenumber, GREATEST(l_quantity, 25) AS g, LEAST(l_quantity, 25) AS s, ABS(l_quantity - 25) AS a,
    {half_up('l_extendedprice / 7', 2)} AS up, {half_even('l_quantity / 8', 1)} AS even, CASE WHEN l_discount <> 0 THEN {half_up('l_tax / NULLIF(l_discount, 0)', 6)} END AS ratio FROM lineitem""")
def _(t):
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.greatest(q, F.lit(25.0)).alias("g"), F.least(q, F.lit(25.0)).alias("s"), F.abs(q - 25).alias("a"),
                             F.round(F.col("l_extendedprice") / 7, 2).alias("up"), F.bround(q / 8, 1).alias("even"), F.round(F.try_divide("l_tax", "l_discount"), 6).alias("ratio"))


@query("x09_log_and_power", f"""SELECT o_orderkey, {half_up('ln(o_totalprice) + 1', 6)} AS ln1, {half_up('log2(o_totalprice)', 6)} AS l2, {half_up('exp(o_totalprice / 1e6)', 6)} AS e,
    {half_up('pow(o_totalprice / 1e5, 0.5)', 6)} AS p FROM orders""")
def _(t):
    x = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.round(F.log(x) + 1, 6).alias("ln1"), F.round(F.log2(x), 6).alias("l2"), F.round(F.exp(x / 1e6), 6).alias("e"),
                           F.round(F.pow(x / 1e5, F.lit(0.5)), 6).alias("p"))


@query("x10_fixed_day_arithmetic", """SELECT o_orderkey, CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS days_to_fixed,
    CAST((SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders) - CAST(o_orderdate AS DATE) AS INTEGER) AS days_to_newest FROM orders""")
def _(t):
    newest = t.orders.agg(F.max("o_orderdate")).scalar()
    return t.orders.select("o_orderkey", F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate").alias("days_to_fixed"),
                           F.datediff(newest, "o_orderdate").alias("days_to_newest"))
