"""Retail customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import count_if, half_up, money, money_avg, n, sql, total
from medalyst.checks.registry import query
from medalyst.plans import customers as p

_ALL = " + ".join(b.SPEND)
_BUYS = " + ".join(b.CHANNELS)


def _totals(where: str = "TRUE") -> str:
    return sql(" UNION ALL ".join(f"SELECT '{s}' AS category, {money(s)} AS total FROM customers WHERE {where}" for s in b.SPEND), "customers")


@query("c01_spend_by_segment", sql(f"""SELECT education, {', '.join(f'{money(s)} AS {s}' for s in b.SPEND)},
    {half_up(' + '.join(money(s) for s in b.SPEND))} AS total_spend FROM customers GROUP BY 1""", "customers"))
def _(t):
    return p.spend_by_segment(b.customers(t), "education", b.SPEND)


@query("c02_category_totals", _totals())
def _(t):
    return p.category_totals(b.customers(t), b.SPEND)


@query("c02_category_totals_high_income", _totals("income > 7000"))
def _(t):
    return p.category_totals(b.customers(t), b.SPEND, F.col("income") > 7000)


@query("c02_category_totals_with_children", _totals("kids + teens > 0"))
def _(t):
    return p.category_totals(b.customers(t), b.SPEND, F.col("kids") + F.col("teens") > 0)


@query("c03_spend_per_customer", sql(f"SELECT education, {n()} AS customers, {half_up(money(_ALL) + ' / COUNT(*)')} AS avg_total_spend FROM customers GROUP BY 1", "customers"))
def _(t):
    return p.spend_per_customer(b.customers(t), "education", b.SPEND)


@query("c04_channel_mix", sql(f"SELECT household, {total('web_purchases')} AS web_purchases, {total('store_purchases')} AS store_purchases FROM customers GROUP BY 1", "customers"))
def _(t):
    return p.channel_mix(b.customers(t), "household", ["web_purchases", "store_purchases"])


@query("c05_repeat_buyers", sql(f"SELECT {count_if('web_purchases + store_purchases = 1')} AS one_time, {count_if('web_purchases + store_purchases > 1')} AS repeat FROM customers", "customers"))
def _(t):
    return p.repeat_buyers(b.customers(t), ["web_purchases", "store_purchases"])


@query("c06_lapsed_customers", sql("SELECT id, recency_days FROM customers WHERE recency_days > 300", "customers"))
def _(t):
    return b.customers(t).where("recency_days > 300").select("id", "recency_days")


@query("c06_loyalty_targets", sql(f"SELECT id, purchases, {half_up('spend')} AS spend FROM (SELECT id, recency_days, {_BUYS} AS purchases, {_ALL} AS spend FROM customers) WHERE recency_days < 400 AND purchases > 7 AND spend > 1500000", "customers"))
def _(t):
    loyal = p.loyalty_targets(b.customers(t), b.SPEND, b.CHANNELS, 400, 7, 1_500_000)
    return loyal.select("id", "purchases", F.round("spend", 2).alias("spend"))


@query("c07_spend_by_age_band", sql(f"""SELECT CASE WHEN 2002 - birth_year <= 30 THEN 'Young' WHEN 2002 - birth_year <= 60 THEN 'Middle-aged' ELSE 'Old' END AS age_band,
    {n()} AS customers, {money(_ALL)} AS total_spend FROM customers GROUP BY 1""", "customers"))
def _(t):
    return p.spend_by_age_band(b.customers(t), b.RETAIL_AS_OF, b.SPEND)


@query("c08_churn_risk", sql(f"""SELECT education, {n()} AS at_risk_customers FROM (SELECT education, {_BUYS} AS purchases, {_ALL} AS spend FROM customers)
    WHERE purchases < (SELECT quantile_cont({_BUYS}, 0.25) FROM customers) AND spend < (SELECT quantile_cont({_ALL}, 0.25) FROM customers) GROUP BY 1""", "customers"))
def _(t):
    return p.churn_risk(b.customers(t), b.SPEND, b.CHANNELS, "education")


@query("c09_segment_profile", sql(f"""SELECT *, education = (SELECT arg_max(education, (deal_purchases, education)) FROM s) AS most_deal_responsive FROM s""", "customers", s=f"""
    SELECT education, {half_up(f'AVG({_BUYS})', 4)} AS avg_frequency, {half_up(f'median({_ALL})')} AS median_spend, {total('deals')} AS deal_purchases FROM customers GROUP BY 1"""))
def _(t):
    return p.segment_profile(b.customers(t), "education", b.SPEND, b.CHANNELS, "deals")


@query("c10_revenue_ranking", sql(f"SELECT education, revenue, {half_up('(MAX(revenue) OVER () - revenue) * 100 / revenue')} AS gap_to_leader_pct FROM (SELECT education, {money(_ALL)} AS revenue FROM customers GROUP BY 1)", "customers"))
def _(t):
    return p.revenue_ranking(b.customers(t), "education", b.SPEND)


def _rfm(t):
    from medalyst.functions.columns import row_total
    from medalyst.operators.cleaning import fill_with_mean
    base = b.customers(t).select("id", "recency_days", row_total(b.CHANNELS).alias("frequency"), F.round(row_total(b.SPEND), 2).alias("monetary"))
    return p.rfm_scores(fill_with_mean(base, ["recency_days"]))


_RFM = f"""SELECT id, recency_days, frequency, monetary, CASE WHEN recency_days <= a THEN 5 WHEN recency_days <= b THEN 4 WHEN recency_days <= c THEN 3 WHEN recency_days <= d THEN 2 ELSE 1 END AS r_score,
    CAST(GREATEST(1, CEIL((ROW_NUMBER() OVER (ORDER BY frequency, id) - 1) * 5.0 / (COUNT(*) OVER () - 1))) AS INTEGER) AS f_score,
    CAST(GREATEST(1, CEIL((ROW_NUMBER() OVER (ORDER BY monetary, id) - 1) * 5.0 / (COUNT(*) OVER () - 1))) AS INTEGER) AS m_score FROM base,
    (SELECT quantile_cont(recency_days, 0.2) AS a, quantile_cont(recency_days, 0.4) AS b, quantile_cont(recency_days, 0.6) AS c, quantile_cont(recency_days, 0.8) AS d FROM base)"""
_RFM_VIEWS = dict(base=f"""SELECT id, COALESCE(CAST(recency_days AS DOUBLE), (SELECT AVG(recency_days) FROM customers)) AS recency_days, {_BUYS} AS frequency,
    {half_up(_ALL)} AS monetary FROM customers""", scored=_RFM,
                  labelled="""SELECT *, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score FROM scored""",
                  final="""SELECT *, CASE WHEN rfm_score >= '555' THEN 'Champions' WHEN rfm_score >= '444' THEN 'Loyal Customers' WHEN rfm_score >= '344' THEN 'Potential Loyalists'
                  WHEN rfm_score >= '244' THEN 'Needs Attention' WHEN rfm_score >= '144' THEN 'At Risk' ELSE 'Lost Customers' END AS segment FROM labelled""")


@query("c11_rfm_scores", sql("SELECT * FROM final", "customers", **_RFM_VIEWS))
def _(t):
    return _rfm(t)


@query("c11_rfm_summary", sql(f"""SELECT segment, {n()} AS customers, {half_up('AVG(recency_days)')} AS avg_recency, {half_up('AVG(frequency)')} AS avg_frequency,
    {half_up(money_avg('monetary'))} AS avg_monetary FROM final GROUP BY 1""", "customers", **_RFM_VIEWS))
def _(t):
    return p.rfm_summary(_rfm(t))


@query("c12_purchase_spend_fit", sql(f"""SELECT {half_up(f'corr({_ALL}, {_BUYS})', 6)} AS pearson_r, {half_up(f'regr_slope({_ALL}, {_BUYS})', 4)} AS slope,
    {half_up(f'regr_intercept({_ALL}, {_BUYS})')} AS intercept FROM customers""", "customers"))
def _(t):
    return p.purchase_spend_fit(b.customers(t), b.SPEND, b.CHANNELS)
