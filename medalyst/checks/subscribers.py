"""Subscribers of two platforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import count_if, half_even, half_up, money, money_avg, n, sql
from medalyst.checks.registry import query
from medalyst.plans import subscribers as p

AS_OF = "2002-01-01"
TIERS = ["Tier 1", "Tier 2", "Tier 3"]
DEVICES = ["Laptop", "Mobile", "TV", "Tablet", "Web"]
_MONTH = "CAST(date_trunc('month', subscription_date) AS DATE)"


def _growth(month: str) -> str:
    return sql(f"""SELECT platform, month, n AS new_subscribers, {half_even('COALESCE((n - LAG(n) OVER w) * 100.0::DOUBLE / LAG(n) OVER w, 0)')} AS growth_pct FROM (
        SELECT platform, {month} AS month, {n()} AS n FROM subs WHERE subscription_date IS NOT NULL GROUP BY ALL) WINDOW w AS (PARTITION BY platform ORDER BY month)""", "subs")


@query("c20_monthly_growth", _growth(_MONTH))
def _(t):
    return p.monthly_growth(b.subscribers(t))


@query("c20_calendar_month_growth", _growth("CAST(month(subscription_date) AS INTEGER)"))
def _(t):
    return p.monthly_growth(b.subscribers(t), by_year=False)


def _retention(by: str, where: str = "TRUE") -> str:
    shares = ", ".join(f"{half_even(count_if(f'd >= {k}') + ' * 100.0::DOUBLE / COUNT(*)')} AS retention_{k}" for k in (30, 60, 90))
    return (f"SELECT {by}, {shares} FROM (SELECT *, GREATEST(COALESCE(plan_change_date - subscription_date, 0), 0) AS d FROM subs WHERE {where}) GROUP BY {by}")


@query("c21_retention", sql(_retention("platform"), "subs"))
def _(t):
    return p.retention(b.subscribers(t), ["platform"])


@query("c21_retention_of_changers", sql(_retention("platform", "plan_change_date IS NOT NULL"), "subs"))
def _(t):
    return p.retention(b.subscribers(t), ["platform"], denominator="changed")


@query("c21_retention_by_age_long", sql(" UNION ALL ".join(
    f"SELECT platform, age_group, 'retention_{k}' AS period, retention_{k} AS retention_pct FROM r" for k in (30, 60, 90)), "subs", r=_retention("platform, age_group")))
def _(t):
    return p.retention_long(p.retention(b.subscribers(t), ["platform", "age_group"]), ["platform", "age_group"])


_CONVERTED = "new_subscription_plan IN ('Basic', 'Premium', 'VIP') AND plan_change_date - subscription_date <= 90"
_CONVERSION = f"""SELECT age_group, city_tier, {n()} AS total_free, {count_if(_CONVERTED)} AS paid_in_time,
    {half_even(count_if(_CONVERTED) + ' * 100.0::DOUBLE / COUNT(*)')} AS conversion_pct FROM subs WHERE subscription_plan = 'Free' GROUP BY ALL"""


@query("c22_conversion", sql(_CONVERSION, "subs"))
def _(t):
    return p.conversion(b.subscribers(t))


@query("c22_conversion_grid", sql("SELECT age_group, " + ", ".join(f"MAX(CASE WHEN city_tier = '{k}' THEN conversion_pct END) AS \"{k}\"" for k in TIERS) + " FROM r GROUP BY 1", "subs", r=_CONVERSION))
def _(t):
    return p.conversion_grid(p.conversion(b.subscribers(t)), TIERS)


@query("c22_upgrade_targets", sql(f"SELECT new_subscription_plan, {n()} AS users FROM subs WHERE subscription_plan = 'Free' AND {_CONVERTED} GROUP BY 1", "subs"))
def _(t):
    return p.early_upgrades(b.subscribers(t)).groupBy("new_subscription_plan").agg(F.count(F.lit(1)).alias("users"))


_CELLS = f"""SELECT city_tier, device_type, {n()} AS user_count, {half_even(money_avg('watch_mins'))} AS avg_watch, {half_even('STDDEV_SAMP(watch_mins)')} AS std_watch FROM engagement,
    (SELECT quantile_cont(watch_mins, 0.25) AS q1, quantile_cont(watch_mins, 0.75) AS q3 FROM engagement) WHERE watch_mins BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY ALL"""
_CELLS2 = f"SELECT *, {half_even('user_count * avg_watch * 0.01')} AS revenue_potential FROM cells"


@query("c23_device_engagement", sql(_CELLS2, "engagement", cells=_CELLS))
def _(t):
    return p.device_engagement(b.engagement(t))


@query("c23_device_grid", sql("SELECT city_tier, " + ", ".join(f"COALESCE(MAX(CASE WHEN device_type = '{d}' THEN avg_watch END), 0) AS \"{d}\"" for d in DEVICES) + " FROM cells GROUP BY 1", "engagement", cells=_CELLS))
def _(t):
    return p.device_grid(p.device_engagement(b.engagement(t)), DEVICES)


@query("c23_cell_uplift", sql(f"""SELECT x AS target_mean, y AS base_mean, {half_up('(x - y) * 100 / y')} AS uplift_pct FROM (SELECT MAX(CASE WHEN city_tier = 'Tier 3' AND device_type = 'TV' THEN avg_watch END) AS x,
    MAX(CASE WHEN city_tier = 'Tier 1' AND device_type = 'Mobile' THEN avg_watch END) AS y FROM cells)""", "engagement", cells=_CELLS))
def _(t):
    return p.cell_uplift(p.device_engagement(b.engagement(t)), ("Tier 3", "TV"), ("Tier 1", "Mobile"))


@query("c23_top_opportunities", sql(f"SELECT city_tier, device_type, revenue_potential FROM ({_CELLS2}) ORDER BY revenue_potential DESC, city_tier, device_type LIMIT 5", "engagement", cells=_CELLS))
def _(t):
    cells = p.device_engagement(b.engagement(t)).select("city_tier", "device_type", "revenue_potential")
    return cells.orderBy(F.desc("revenue_potential"), "city_tier", "device_type").limit(5)


@query("c24_labelled_segments", sql(f"""SELECT platform, segment, watch_mins, {half_even('watch_mins * 100 / SUM(watch_mins) OVER (PARTITION BY platform)')} AS pct_of_platform FROM (
    SELECT platform, CASE WHEN watch_mins > 800 AND device_type IN ('TV', 'Laptop') THEN 'Heavy Multi-Device Users' WHEN watch_mins <= 500 AND device_type = 'Mobile' THEN 'Light Mobile Viewers'
    WHEN watch_mins <= 400 AND device_type = 'TV' THEN 'Occasional TV Watchers' ELSE 'Low-Engagement Users' END AS segment, {money('watch_mins')} AS watch_mins FROM engagement GROUP BY ALL)""", "engagement"))
def _(t):
    w, d = F.col("watch_mins"), F.col("device_type")
    rules = [((w > 800) & d.isin("TV", "Laptop"), "Heavy Multi-Device Users"), ((w <= 500) & (d == "Mobile"), "Light Mobile Viewers"), ((w <= 400) & (d == "TV"), "Occasional TV Watchers")]
    return p.labelled_segments(b.engagement(t), rules)


_RISK = f"""SELECT *, {half_even('(watch_risk + days_risk) / 2')} AS inactivity_risk FROM (SELECT e.*, CASE WHEN watch_mins <= q1 THEN 1.0 WHEN watch_mins <= q2 THEN 0.75 WHEN watch_mins <= q3 THEN 0.5 ELSE 0.0 END::DOUBLE AS watch_risk,
    COALESCE((days - MIN(days) OVER ()) / NULLIF(MAX(days) OVER () - MIN(days) OVER (), 0)::DOUBLE, 0.0) AS days_risk FROM (SELECT *, COALESCE((SELECT MAX(plan_change_date) FROM engagement) - plan_change_date, 0) AS days FROM engagement) e,
    (SELECT quantile_cont(watch_mins, 0.25) AS q1, quantile_cont(watch_mins, 0.5) AS q2, quantile_cont(watch_mins, 0.75) AS q3 FROM engagement))"""


@query("c25_inactivity_risk", sql(f"SELECT user_id, device_type, watch_risk, {half_up('days_risk', 9)} AS days_risk, inactivity_risk FROM risk", "engagement", risk=_RISK))
def _(t):
    return p.inactivity_risk(b.engagement(t)).select("user_id", "device_type", "watch_risk", F.round("days_risk", 9).alias("days_risk"), "inactivity_risk")


@query("c25_reengagement", sql(f"""SELECT {n()} AS at_risk_users, {half_up(money_avg('inactivity_risk') + ' - ' + money_avg(half_even('inactivity_risk * 0.7')), 4)} AS mean_reduction FROM risk
    WHERE age_group = '35-44' AND inactivity_risk >= (SELECT quantile_cont(inactivity_risk, 0.2) FROM risk WHERE age_group = '35-44')""", "engagement", risk=_RISK))
def _(t):
    return p.reengagement(p.inactivity_risk(b.engagement(t)), "35-44")


_REVENUE = f"""SELECT *, m * plan_price AS prorated_revenue FROM (SELECT *, {half_even(f"GREATEST(COALESCE(COALESCE(last_active_date, DATE '{AS_OF}') - subscription_date, 0), 0) / 30.0::DOUBLE")} AS m FROM viewers)"""


@query("c26_prorated_revenue", sql(f"SELECT user_id, m AS active_months, {half_up('prorated_revenue')} AS prorated_revenue FROM r", "viewers", r=_REVENUE))
def _(t):
    return p.prorated(b.viewers(t), AS_OF).select("user_id", "active_months", F.round("prorated_revenue", 2).alias("prorated_revenue"))


@query("c26_revenue_by_plan", sql(f"SELECT COALESCE(g, 'Overall') AS platform, city_tier, subscription_plan, prorated_revenue FROM (SELECT platform AS g, city_tier, subscription_plan, {money('prorated_revenue')} AS prorated_revenue FROM r GROUP BY GROUPING SETS ((platform, city_tier, subscription_plan), (city_tier, subscription_plan)))", "viewers", r=_REVENUE))
def _(t):
    return p.revenue_by_plan(p.prorated(b.viewers(t), AS_OF))


@query("c26_high_watch_share", sql(f"""SELECT {money("CASE WHEN city_tier = 'Tier 2' AND watch_mins > med THEN prorated_revenue ELSE 0 END")} AS segment_revenue, {money('prorated_revenue')} AS total_revenue,
    {half_up(money("CASE WHEN city_tier = 'Tier 2' AND watch_mins > med THEN prorated_revenue ELSE 0 END") + ' * 100 / ' + money('prorated_revenue'))} AS share_pct FROM r, (SELECT median(watch_mins) AS med FROM r)""", "viewers", r=_REVENUE))
def _(t):
    return p.high_watch_share(p.prorated(b.viewers(t), AS_OF), "Tier 2")


_RANK = "CASE {0} WHEN 'Free' THEN 0 WHEN 'Basic' THEN 1 WHEN 'Premium' THEN 2 WHEN 'VIP' THEN 3 END"
_MOVES = f"""SELECT *, CASE WHEN {_RANK.format('new_subscription_plan')} > {_RANK.format('subscription_plan')} THEN 'Upgrade' WHEN {_RANK.format('new_subscription_plan')} < {_RANK.format('subscription_plan')} THEN 'Downgrade'
    ELSE 'No Change' END AS plan_move, CAST(plan_change_date IS NOT NULL AND {_RANK.format('new_subscription_plan')} < {_RANK.format('subscription_plan')} AS INTEGER) AS downgrade_flag FROM subs"""


@query("c27_plan_moves", sql(f"SELECT platform, plan_move, {n()} AS users FROM m GROUP BY ALL", "subs", m=_MOVES))
def _(t):
    return p.move_counts(b.subscribers(t))


@query("c27_downgrade_flags", sql("SELECT user_id, downgrade_flag FROM m", "subs", m=_MOVES))
def _(t):
    return p.with_downgrade_flag(b.subscribers(t)).select("user_id", "downgrade_flag")


_CURVE = f"""SELECT platform, subscription_plan, CAST(month AS INTEGER) AS month, {count_if('tenure >= month')} AS retained, {half_up(f"{count_if('tenure >= month')} * AVG(plan_price)")} AS revenue FROM (
    SELECT *, (2002 - year(subscription_date)) * 12 + 1 - month(subscription_date) AS tenure FROM subs WHERE subscription_date IS NOT NULL), (SELECT UNNEST(range(0, 12)) AS month) GROUP BY ALL"""


@query("c28_cohort_revenue_curve", sql(_CURVE, "subs"))
def _(t):
    return p.cohort_revenue_curve(b.subscribers(t), ["platform", "subscription_plan"], AS_OF)


@query("c28_lifetime_value", sql(f"SELECT platform, subscription_plan, {money('revenue')} AS ltv FROM c GROUP BY ALL", "subs", c=_CURVE))
def _(t):
    return p.lifetime_value(p.cohort_revenue_curve(b.subscribers(t), ["platform", "subscription_plan"], AS_OF), ["platform", "subscription_plan"])


@query("c29_acquisition_growth", sql(f"""SELECT city_tier, {half_even('AVG(n)')} AS avg_monthly_subs, CAST(SUM(n) AS BIGINT) AS total_subs, {half_even('AVG(ch)')} AS avg_growth_pct,
    {half_even('(pow(arg_max(n, month) / arg_min(n, month)::DOUBLE, 12.0 / COUNT(*)) - 1) * 100')} AS cagr_pct FROM (SELECT *, COALESCE((n - LAG(n) OVER w) * 100.0::DOUBLE / LAG(n) OVER w, 0) AS ch FROM (
    SELECT city_tier, {_MONTH} AS month, {n()} AS n FROM subs WHERE subscription_date IS NOT NULL GROUP BY ALL) WINDOW w AS (PARTITION BY city_tier ORDER BY month)) GROUP BY 1""", "subs"))
def _(t):
    return p.acquisition_by_tier(b.subscribers(t))


_BOOST = f"""SELECT platform, month, {half_up('rate', 6)} AS retention_rate, {half_up('lifted', 6)} AS retention_boosted, {half_up('COALESCE((lifted - rate) * 100 / NULLIF(rate, 0), 0)', 4)} AS uplift_pct FROM (
    SELECT *, CASE WHEN platform = 'A' THEN LEAST(rate * 1.15::DOUBLE, 1.0::DOUBLE) ELSE rate END AS lifted FROM (SELECT platform, {_MONTH} AS month, 1.0::DOUBLE - AVG(inactivity_flag) AS rate FROM subs WHERE subscription_date IS NOT NULL GROUP BY ALL))"""


@query("c30_boosted_retention", sql(_BOOST, "subs"))
def _(t):
    return p.boosted_retention(b.subscribers(t), "A")


@query("c30_uplift_value", sql(f"""SELECT {half_up('lift', 4)} AS mean_uplift_pct, {half_up('AVG(plan_price)', 4)} AS mean_price, {count_if("subscription_plan = 'Basic'")} AS cohort,
    {half_up("lift / 100 * 12 * AVG(plan_price) * " + count_if("subscription_plan = 'Basic'"))} AS uplift_value FROM subs, (SELECT AVG(uplift_pct) AS lift FROM bo WHERE platform = 'A') WHERE platform = 'A' GROUP BY lift""", "subs", bo=_BOOST))
def _(t):
    return p.uplift_value(p.boosted_retention(b.subscribers(t), "A"), b.subscribers(t), "A", "Basic")


_PRE = "CASE WHEN plan_move = 'Downgrade' THEN plan_price * 0.5 * 12 ELSE plan_price * 12 END"
_POST = f"CASE WHEN platform = 'A' THEN {_PRE} * 1.2 ELSE {_PRE} END"


@query("c31_synergy_scenario", sql(f"SELECT {money(_PRE)} AS revenue_before, {money(_POST)} AS revenue_after, {half_up(f'({money(_POST)} - {money(_PRE)}) * 100 / {money(_PRE)}')} AS increase_pct FROM m", "subs", m=_MOVES))
def _(t):
    return p.synergy_scenario(p.with_plan_move(b.subscribers(t)), "A")


_SWITCH = f"""SELECT user_id, pre, post, city_tier, {half_up('post - pre')} AS diff FROM (SELECT user_id, {money("CASE WHEN device_type <> 'Laptop' THEN watch_mins END")} AS pre,
    {money("CASE WHEN device_type = 'Laptop' THEN watch_mins END")} AS post, MIN(city_tier) AS city_tier FROM engagement GROUP BY 1) WHERE pre > 0 AND post > 0"""


@query("c32_device_switchers", sql(_SWITCH, "engagement"))
def _(t):
    return p.laptop_switchers(b.engagement(t))


@query("c32_switcher_summary", sql(f"SELECT city_tier, {n()} AS users, {half_even(money_avg('diff'))} AS mean_diff, {half_even('STDDEV_SAMP(diff)')} AS std_diff FROM s GROUP BY 1", "engagement", s=_SWITCH))
def _(t):
    return p.switcher_summary(p.laptop_switchers(b.engagement(t)))


@query("c33_activity_states", sql(f"""SELECT state, {n()} AS users, {half_even('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()')} AS pct FROM (SELECT CASE WHEN last_active_date IS NULL OR watch_mins = 0 THEN 'Inactive'
    WHEN watch_mins >= h THEN 'Active' ELSE 'Low Watch' END AS state FROM viewers, (SELECT quantile_cont(watch_mins, 0.75) AS h FROM viewers WHERE watch_mins > 0)) GROUP BY 1""", "viewers"))
def _(t):
    return p.activity_states(b.viewers(t))


_W = "CASE subscription_plan WHEN 'Basic' THEN 2 WHEN 'Premium' THEN 3 WHEN 'VIP' THEN 4 ELSE 1 END"
_WEIGHTS = f"""SELECT COALESCE(g, 'Merged') AS platform, age_group, city_tier, weight, users FROM (SELECT platform AS g, age_group, city_tier, CAST(SUM({_W}) AS BIGINT) AS weight, {n()} AS users FROM subs
    GROUP BY GROUPING SETS ((platform, age_group, city_tier), (age_group, city_tier)))"""
_SHARES = "SELECT *, weight / SUM(weight) OVER (PARTITION BY platform)::DOUBLE AS p FROM w"
_DIVERSITY = f"""SELECT platform, {half_up('1.0 - SUM(p * p)', 6)} AS simpson, {half_up('-SUM(p * log2(p))', 6)} AS shannon, {n()} AS segments, CAST(SUM(users) AS BIGINT) AS users, CAST(SUM(weight) AS BIGINT) AS total_weight FROM s GROUP BY 1"""


@query("c34_diversity", sql(_DIVERSITY, "subs", w=_WEIGHTS, s=_SHARES))
def _(t):
    return p.diversity(p.segment_weights(b.subscribers(t)))


@query("c35_concentration", sql(f"""SELECT platform, {half_up('SUM(p)', 6)} AS top_share, SUM(p) > 0.5 AS concentrated FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY platform ORDER BY p DESC, age_group, city_tier) AS r FROM s) WHERE r <= 3 GROUP BY 1""",
                                "subs", w=_WEIGHTS, s=_SHARES))
def _(t):
    return p.concentration(p.segment_weights(b.subscribers(t)))


@query("c35_synergy", sql(f"""SELECT {half_up("MAX(CASE WHEN platform = 'Merged' THEN shannon END)", 6)} AS merged_entropy, {half_up("AVG(CASE WHEN platform <> 'Merged' THEN shannon END)", 6)} AS mean_entropy,
    {half_up("MAX(CASE WHEN platform = 'Merged' THEN shannon END) - AVG(CASE WHEN platform <> 'Merged' THEN shannon END)", 6)} AS synergy FROM d""", "subs", w=_WEIGHTS, s=_SHARES, d=_DIVERSITY))
def _(t):
    return p.diversity_synergy(p.diversity(p.segment_weights(b.subscribers(t))))


@query("c35_scaled_diversity", sql(f"""SELECT platform, {half_up('(shannon - MIN(shannon) OVER ()) / NULLIF(MAX(shannon) OVER () - MIN(shannon) OVER (), 0)', 6)} AS shannon_norm FROM d""", "subs", w=_WEIGHTS, s=_SHARES, d=_DIVERSITY))
def _(t):
    from medalyst.operators.cleaning import min_max_scaled
    scores = p.diversity(p.segment_weights(b.subscribers(t)))
    return min_max_scaled(scores, "shannon", "shannon_norm").select("platform", F.round("shannon_norm", 6).alias("shannon_norm"))


@query("c36_cohort_decay", sql(f"""SELECT platform, CAST(age AS BIGINT) AS age_months, COALESCE(r, 0.0) AS revenue FROM (SELECT platform, UNNEST(range(0, MAX(age_months) + 1)) AS age FROM a GROUP BY 1) LEFT JOIN (
    SELECT platform, age_months AS age, {money('plan_price')} AS r FROM a GROUP BY ALL) USING (platform, age)""", "subs",
                               a=f"SELECT platform, plan_price, GREATEST((DATE '{AS_OF}' - subscription_date) // 30, 0) AS age_months FROM subs WHERE subscription_date < DATE '{AS_OF}'"))
def _(t):
    return p.cohort_decay(b.subscribers(t), "platform", AS_OF)


_NARROW = "(SELECT COUNT(*) FROM subs WHERE platform = 'A' AND year(subscription_date) = 1995 AND month(subscription_date) BETWEEN 4 AND 6)"


@query("c36_acquired_cohort", sql(f"""SELECT user_id, subscription_date, CAST({_NARROW} AS BIGINT) AS range_users, CASE WHEN {_NARROW} >= 50 THEN '4-6' ELSE '1-9' END AS cohort_range FROM subs WHERE platform = 'A' AND year(subscription_date) = 1995 AND CASE WHEN (SELECT COUNT(*) FROM subs WHERE platform = 'A' AND year(subscription_date) = 1995
    AND month(subscription_date) BETWEEN 4 AND 6) >= 50 THEN month(subscription_date) BETWEEN 4 AND 6 ELSE month(subscription_date) BETWEEN 1 AND 9 END""", "subs"))
def _(t):
    return p.acquired_between(b.subscribers(t), "A", 1995, (4, 6), (1, 9)).select("user_id", "subscription_date", "range_users", "cohort_range")


_STEPS = [("signup", "COUNT(*)"), ("paid", "COUNT(*) FILTER (WHERE plan_price > 0)"), ("active", "COUNT(*) FILTER (WHERE act)"), ("high_engagement", "COUNT(*) FILTER (WHERE watch_mins >= h)")]
_FUNNEL = " UNION ALL ".join(f"SELECT {i} AS step, '{s}' AS stage, CAST({e} AS BIGINT) AS users, {n()} AS al FROM f" for i, (s, e) in enumerate(_STEPS))


@query("c37_funnel", sql(f"""SELECT step, stage, users, {half_even('users * 100.0::DOUBLE / al', 1)} AS pct_of_signup, {half_even('users * 100.0::DOUBLE / NULLIF(LAG(users) OVER w, 0)', 1)} AS step_rate_pct,
    {half_even('COALESCE((users - LAG(users) OVER w) * 100.0::DOUBLE / NULLIF(LAG(users) OVER w, 0), 100)', 1)} AS step_change_pct, COALESCE(ABS(users - LAG(users) OVER w), 0) AS dropoff FROM u WINDOW w AS (ORDER BY step)""", "viewers",
                         f0="SELECT *, COALESCE(watch_mins > 0 AND last_active_date >= DATE '2001-06-01', FALSE) AS act FROM viewers WHERE city_tier = 'Tier 2'",
                         f="SELECT f0.*, h FROM f0, (SELECT quantile_cont(watch_mins, 0.75) AS h FROM f0 WHERE act)", u=_FUNNEL))
def _(t):
    return p.funnel(b.viewers(t).where("city_tier = 'Tier 2'"), "2001-06-01")


@query("c38_cohort_overlap", sql(f"""SELECT found_in, {n()} AS users, {money('COALESCE(v1, 0.0) + COALESCE(v2, 0.0)')} AS watch_mins FROM (SELECT v1, v2, CASE WHEN v2 IS NULL THEN 'first only' WHEN v1 IS NULL THEN 'second only' ELSE 'both' END AS found_in FROM
    (SELECT user_id, {money('watch_mins')} AS v1 FROM engagement WHERE device_type = 'TV' AND plan_price > 0 GROUP BY 1) FULL JOIN (SELECT user_id, {money('watch_mins')} AS v2 FROM engagement WHERE device_type = 'Mobile' AND plan_price > 100 GROUP BY 1) USING (user_id)) GROUP BY 1""", "engagement"))
def _(t):
    e = b.engagement(t)
    return p.cohort_overlap(e.where("device_type = 'TV' AND plan_price > 0"), e.where("device_type = 'Mobile' AND plan_price > 100"))


_TARGET = """SELECT *, (1.0 - watch_mins / (m + 1)) * CASE subscription_plan WHEN 'Free' THEN 1.0 WHEN 'Basic' THEN 0.8 WHEN 'Premium' THEN 0.5 WHEN 'VIP' THEN 0.3 ELSE 0.5 END::DOUBLE AS score FROM viewers, (SELECT MAX(watch_mins) AS m FROM viewers)"""


@query("c39_target_scores", sql(f"SELECT city_tier, subscription_plan, {half_up(money_avg('score', 9), 6)} AS mean_score, {n()} AS users FROM s GROUP BY ALL", "viewers", s=_TARGET))
def _(t):
    return p.target_grid(p.target_scores(b.viewers(t)))


@query("c39_projected_users", sql(f"SELECT {n()} AS baseline_users, CAST(FLOOR(COUNT(*) * 0.15::DOUBLE) AS BIGINT) AS projected_users FROM viewers", "viewers"))
def _(t):
    return p.projected_users(b.viewers(t), 0.15)


@query("c40_platform_totals", sql(f"""SELECT platform, {n()} AS records, {money('watch_mins')} AS total_watch, {half_up(money_avg('watch_mins'), 4)} AS mean_watch, {n('DISTINCT city_tier')} AS tiers, {n('DISTINCT device_type')} AS devices
    FROM engagement GROUP BY 1""", "engagement"))
def _(t):
    return p.platform_totals(b.engagement(t))


@query("c41_value_tiers", sql(f"""SELECT value_tier, platform, {n()} AS users, {half_even('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (PARTITION BY value_tier)')} AS pct_of_tier FROM (SELECT platform, CASE WHEN plan_price > hi THEN 'high' WHEN plan_price <= lo THEN 'low' END AS value_tier
    FROM subs, (SELECT quantile_cont(plan_price, 0.25) AS lo, quantile_cont(plan_price, 0.75) AS hi FROM subs)) WHERE value_tier IS NOT NULL GROUP BY value_tier, platform""", "subs"))
def _(t):
    return p.value_tiers(b.subscribers(t))


@query("c41_quartile_revenue", sql(f"""SELECT *, {half_up('mean_price * users')} AS total_revenue, {half_up("MAX(CASE WHEN quartile = 'Q4' THEN mean_price END) OVER () - MAX(CASE WHEN quartile = 'Q1' THEN mean_price END) OVER ()")} AS top_bottom_gap FROM (
    SELECT CASE WHEN watch_mins <= q1 THEN 'Q1' WHEN watch_mins <= q2 THEN 'Q2' WHEN watch_mins <= q3 THEN 'Q3' ELSE 'Q4' END AS quartile, {n()} AS users, {half_even(money_avg('plan_price'))} AS mean_price FROM engagement,
    (SELECT quantile_cont(watch_mins, 0.25) AS q1, quantile_cont(watch_mins, 0.5) AS q2, quantile_cont(watch_mins, 0.75) AS q3 FROM engagement) GROUP BY 1)""", "engagement"))
def _(t):
    return p.quartile_revenue(b.engagement(t), "watch_mins")
