"""Clustering, projection, anomalies, decay, matching, transitions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import count_if, half_even, half_up, n, sql
from medalyst.checks.registry import query
from medalyst.operators import ml, series, stats
from medalyst.operators.forest import anomaly_scores, flagged_anomalies
from medalyst.session import durable

_FEATURES = ["income", "recency_days", "web_purchases", "store_purchases", *b.SPEND]


@query("m01_standard_scaled", f"""SELECT l_orderkey, l_linenumber, {half_up('(l_quantity - AVG(l_quantity) OVER ()) / STDDEV_SAMP(l_quantity) OVER ()', 6)} AS z_quantity,
    {half_up('(l_discount - AVG(l_discount) OVER ()) / STDDEV_SAMP(l_discount) OVER ()', 6)} AS z_discount FROM lineitem""")
def _(t):
    scaled = ml.scaled_features(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"), ["l_quantity", "l_discount"])
    z = vector_to_array("features")
    return scaled.select("l_orderkey", "l_linenumber", F.round(z[0], 6).alias("z_quantity"), F.round(z[1], 6).alias("z_discount"))


def _vectors(t):
    return t.embeddings.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query("m02_kmeans_by_silhouette")
def _(t):
    model, _scores = ml.best_kmeans(_vectors(t), range(2, 11))
    return ml.assigned(model, _vectors(t)).groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))


@query("m02_silhouette_by_k")
def _(t):
    scaled = durable(ml.scaled_features(b.customers(t), _FEATURES).select("id", "features"))
    scores = ml.silhouettes(scaled, range(2, 11))
    return t.spark.createDataFrame([(k, float(v)) for k, v in scores.items()], "k int, silhouette double")


@query("m03_kmeans_chosen_on_sample")
def _(t):
    scaled = durable(ml.scaled_features(b.engagement(t), ["watch_mins", "plan_price"]))
    model, _scores = ml.best_kmeans(scaled, range(2, 6), sample=0.1)
    return ml.assigned(model, scaled).groupBy("cluster", "platform").agg(F.count(F.lit(1)).alias("users"), F.round(F.avg("watch_mins"), 2).alias("mean_watch"))


@query("m04_principal_components")
def _(t):
    scaled = durable(ml.scaled_features(b.customers(t), _FEATURES).select("id", "features"))
    model, kept = ml.principal_components(scaled, len(_FEATURES), variance=0.95)
    return ml.component_table(model, _FEATURES, scaled.count(), t.spark, kept)


@query("m04_projected_quartiles")
def _(t):
    from medalyst.plans.subscribers import quartile_revenue
    scaled = durable(ml.scaled_features(b.viewers(t), ["watch_mins", "plan_price", "inactivity_flag"]))
    model, kept = ml.principal_components(scaled, 3, k=2)
    return quartile_revenue(ml.projected(model, scaled, kept).select("pc1", "plan_price"), "pc1")


def _anomalies(t):
    # one narrow row per event: the group is the event type, the feature its value
    rows = t.events.select("event_id", "event_type", "value", "user_id")
    return flagged_anomalies(anomaly_scores(rows, "event_type", "event_id", ["value"]), "event_type")


@query("m05_isolation_forest")
def _(t):
    return _anomalies(t).select("event_id", "event_type", "anomaly_flag", F.round("anomaly_probability", 6).alias("anomaly_probability"))


@query("m05_flagged_share", f"SELECT event_type, {n()} AS n_rows, TRUE AS enough, TRUE AS share_kept FROM events GROUP BY 1")
def _(t):
    rows = F.count(F.lit(1))
    return _anomalies(t).groupBy("event_type").agg(rows.alias("n_rows"), F.min("enough").alias("enough"), F.sum("anomaly_flag").between(1, F.ceil(0.1 * rows)).alias("share_kept"))


# M06 works on any 0/1 anomaly flag; here the flag is the value fence, so that SQL can check the reports.
_FLAGGED = """SELECT e.*, CAST(e.watch_mins > q3 AS INTEGER) AS anomaly_flag, CAST(CASE new_subscription_plan WHEN 'Free' THEN 0 WHEN 'Basic' THEN 1 WHEN 'Premium' THEN 2 ELSE 3 END
    < CASE subscription_plan WHEN 'Free' THEN 0 WHEN 'Basic' THEN 1 WHEN 'Premium' THEN 2 ELSE 3 END AND plan_change_date IS NOT NULL AS INTEGER) AS downgrade_flag
    FROM engagement e, (SELECT quantile_cont(watch_mins, 0.9) AS q3 FROM engagement)"""


def _flagged(t):
    from medalyst.operators.quantiles import quantile_struct
    from medalyst.plans.subscribers import with_downgrade_flag
    e = durable(with_downgrade_flag(b.engagement(t)))
    return e.withColumn("anomaly_flag", (F.col("watch_mins") > quantile_struct(e, "watch_mins", {"q": 0.9})["q"]).cast("int"))


@query("m06_downgrade_rates", sql(f"SELECT anomaly_flag, {n()} AS users, {half_even('AVG(downgrade_flag)', 4)} AS downgrade_rate, {half_even('STDDEV_SAMP(downgrade_flag)', 4)} AS rate_std FROM f GROUP BY 1", "engagement", f=_FLAGGED))
def _(t):
    return _flagged(t).groupBy("anomaly_flag").agg(F.count(F.lit(1)).alias("users"), F.bround(F.avg("downgrade_flag"), 4).alias("downgrade_rate"),
                                                   F.bround(F.stddev_samp("downgrade_flag"), 4).alias("rate_std"))


@query("m06_correlation_by_device", sql(f"SELECT device_type, {half_up('corr(anomaly_flag, downgrade_flag)', 6)} AS correlation FROM f GROUP BY 1", "engagement", f=_FLAGGED))
def _(t):
    return _flagged(t).groupBy("device_type").agg(F.round(F.corr("anomaly_flag", "downgrade_flag"), 6).alias("correlation"))


@query("m06_high_risk_rows", sql("SELECT user_id, device_type, watch_mins FROM f WHERE anomaly_flag = 1 AND downgrade_flag = 1", "engagement", f=_FLAGGED))
def _(t):
    return _flagged(t).where("anomaly_flag = 1 AND downgrade_flag = 1").select("user_id", "device_type", "watch_mins")


@query("m06_summary", sql(f"""SELECT device_type, anomaly_flag, platform, {half_even('AVG(watch_mins)')} AS watch_mean, {n()} AS users, MIN(watch_mins) AS watch_min, MAX(watch_mins) AS watch_max,
    {half_even('AVG(downgrade_flag)')} AS downgrade_rate FROM f GROUP BY ALL""", "engagement", f=_FLAGGED))
def _(t):
    return _flagged(t).groupBy("device_type", "anomaly_flag", "platform").agg(
        F.bround(F.avg("watch_mins"), 2).alias("watch_mean"), F.count(F.lit(1)).alias("users"), F.min("watch_mins").alias("watch_min"),
        F.max("watch_mins").alias("watch_max"), F.bround(F.avg("downgrade_flag"), 2).alias("downgrade_rate"))


@query("m06_independence", sql(f"""SELECT {', '.join(f"CAST({count_if(c)} AS DOUBLE) AS {k}" for k, c in (('n11', 'anomaly_flag = 1 AND downgrade_flag = 1'), ('n10', 'anomaly_flag = 1 AND downgrade_flag = 0'),
    ('n01', 'anomaly_flag = 0 AND downgrade_flag = 1'), ('n00', 'anomaly_flag = 0 AND downgrade_flag = 0')))} FROM f""", "engagement", f=_FLAGGED))
def _(t):
    out = stats.chi_square_2x2(_flagged(t), F.col("anomaly_flag") == 1, F.col("downgrade_flag") == 1)
    return out.select("n11", "n10", "n01", "n00")


_CURVE = f"""SELECT platform, month, {count_if('tenure >= month')} AS retained, {half_up(f"{count_if('tenure >= month')} * AVG(plan_price)")} AS revenue FROM (
    SELECT *, (2002 - year(subscription_date)) * 12 + 1 - month(subscription_date) AS tenure FROM subs WHERE subscription_date IS NOT NULL), (SELECT UNNEST(range(0, 60)) AS month) GROUP BY ALL"""


@query("m07_decay_fit", sql(f"""SELECT platform, {n()} AS points, {half_up('exp(regr_intercept(ln(revenue), month))', 2)} AS a, {half_up('-regr_slope(ln(revenue), month)', 9)} AS b, {half_up('regr_r2(ln(revenue), month)', 6)} AS r2,
    {half_up('CASE WHEN regr_slope(ln(revenue), month) < 0 THEN ln(2) / -regr_slope(ln(revenue), month) END', 4)} AS half_life FROM c WHERE revenue > 0 GROUP BY 1""", "subs", c=_CURVE))
def _(t):
    from medalyst.plans.subscribers import cohort_revenue_curve
    curve = cohort_revenue_curve(b.subscribers(t), ["platform"], "2002-01-01", months=60)
    fit = series.decay_fit(curve, ["platform"], "month", "revenue")
    return fit.withColumns({"a": F.round("a", 2), "b": F.round("b", 9), "r2": F.round("r2", 6), "half_life": F.round("half_life", 4)})


@query("m08_nearest_score_match", f"""WITH u AS (SELECT ROUND(c_acctbal) AS s, c_nationkey % 3 = 0 AS w, c_custkey % 7 AS y FROM customer),
    v AS (SELECT s, {count_if('w')} AS n1, COALESCE(SUM(y) FILTER (WHERE w), 0) AS y1, {count_if('NOT w')} AS n0, COALESCE(SUM(y) FILTER (WHERE NOT w), 0) AS y0 FROM u GROUP BY 1),
    x AS (SELECT *, MAX(CASE WHEN n0 > 0 THEN s END) OVER up AS c_lo, MIN(CASE WHEN n0 > 0 THEN s END) OVER down AS c_hi, MAX(CASE WHEN n1 > 0 THEN s END) OVER up AS t_lo, MIN(CASE WHEN n1 > 0 THEN s END) OVER down AS t_hi FROM v
      WINDOW up AS (ORDER BY s ROWS UNBOUNDED PRECEDING), down AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
    m AS (SELECT *, CASE WHEN c_hi IS NULL OR (c_lo IS NOT NULL AND s - c_lo <= c_hi - s) THEN c_lo ELSE c_hi END AS mc, CASE WHEN t_hi IS NULL OR (t_lo IS NOT NULL AND s - t_lo <= t_hi - s) THEN t_lo ELSE t_hi END AS mt FROM x),
    g AS (SELECT 'treated' AS arm, SUM(m.y1 - c.y0 / c.n0::DOUBLE * m.n1) AS gain, SUM(m.n1) AS k FROM m JOIN v c ON c.s = m.mc WHERE m.n1 > 0
      UNION ALL SELECT 'control', -SUM(m.y0 - c.y1 / c.n1::DOUBLE * m.n0), SUM(m.n0) FROM m JOIN v c ON c.s = m.mt WHERE m.n0 > 0)
    SELECT {half_up('SUM(gain) / SUM(k)', 9)} AS ate, {half_up("MAX(CASE WHEN arm = 'treated' THEN gain / k END)", 9)} AS att, CAST(SUM(CASE WHEN arm = 'treated' THEN k END) AS BIGINT) AS n_treated,
      CAST(SUM(CASE WHEN arm = 'control' THEN k END) AS BIGINT) AS n_control FROM g""")
def _(t):
    rows = t.customer.selectExpr("round(c_acctbal) AS s", "int(c_nationkey % 3 = 0) AS w", "c_custkey % 7 AS y")
    return ml.matched_effect(rows, "s", "w", "y").withColumns({"ate": F.round("ate", 9), "att": F.round("att", 9)})


@query("m08_propensity_effect")
def _(t):
    from medalyst.functions.columns import one_hot
    users = b.viewers(t)
    coded = users.select("user_id", "inactivity_flag", (F.col("plan_price") > 100).cast("int").alias("treated"), "watch_mins",
                         *one_hot("age_group", ["18-24", "25-34", "35-44", "45+"], "age"), *one_hot("city_tier", ["Tier 1", "Tier 2", "Tier 3"], "tier"))
    renamed = coded.withColumnsRenamed({c: c.replace("-", "_").replace("+", "").replace(" ", "_") for c in coded.columns})
    covariates = [c for c in renamed.columns if c.startswith(("age_", "tier_"))]
    return ml.propensity_effect(durable(renamed), "treated", "inactivity_flag", [*covariates, "watch_mins"])


_STATES = """SELECT o_custkey AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CASE WHEN SUM(o_totalprice) > 400000 THEN 'high' WHEN SUM(o_totalprice) > 150000 THEN 'mid' ELSE 'low' END AS state FROM orders GROUP BY 1, 2"""
_MOVED = f"""SELECT from_state, state AS to_state, {n()} AS moves, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY from_state)::DOUBLE AS share FROM (SELECT *, LAG(state) OVER (PARTITION BY k ORDER BY month) AS from_state FROM st) WHERE from_state IS NOT NULL GROUP BY ALL"""


def _states(t):
    from medalyst.functions.columns import exact_sum, ladder, month_start
    monthly = t.orders.groupBy(F.col("o_custkey").alias("k"), month_start("o_orderdate").alias("month")).agg(exact_sum("o_totalprice").alias("s"))
    return monthly.select("k", "month", ladder([(F.col("s") > 400000, "high"), (F.col("s") > 150000, "mid")], "low").alias("state"))


@query("m09_state_moves", sql(f"SELECT from_state, to_state, moves, {half_up('share', 9)} AS share FROM mv", st=_STATES, mv=_MOVED.replace("GROUP BY ALL", "GROUP BY 1, 2")))
def _(t):
    return series.state_moves(_states(t), "k", "month", "state").withColumn("share", F.round("share", 9))


@query("m09_shares_after_three_steps", sql(f"""SELECT a.from_state, c.to_state, {half_up('SUM(a.share * b.share * c.share)', 6)} AS share FROM mv a JOIN mv b ON a.to_state = b.from_state JOIN mv c ON b.to_state = c.from_state GROUP BY 1, 2""",
                                           st=_STATES, mv=_MOVED.replace("GROUP BY ALL", "GROUP BY 1, 2")))
def _(t):
    moves = durable(series.state_moves(_states(t), "k", "month", "state"))
    return series.moves_after(moves, 3).withColumn("share", F.round("share", 6))
