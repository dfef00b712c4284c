"""Retail customer analytics over a one-row-per-customer table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.functions.columns import exact_sum, ladder, pct, row_total
from medalyst.operators.quantiles import exact_quantiles, quantile_struct, with_all_rank_bins, with_value_bins
from medalyst.operators.relational import null_safe_join
from medalyst.operators.reshape import columns_to_rows
from medalyst.session import durable

# Lexicographic lower bounds of the RFM score text and their segments (fixed values).
RFM_SEGMENTS = (("555", "Champions"), ("444", "Loyal Customers"), ("344", "Potential Loyalists"),
                ("244", "Needs Attention"), ("144", "At Risk"))
RFM_REST = "Lost Customers"


def spend_by_segment(customers: DataFrame, segment: str, spend: Sequence[str]) -> DataFrame:
    """Spend per category and in total for each segment."""
    sums = customers.groupBy(segment).agg(*[exact_sum(c).alias(c) for c in spend])
    return sums.withColumn("total_spend", F.round(row_total(spend), 2))


def category_totals(customers: DataFrame, spend: Sequence[str], where: Column | None = None) -> DataFrame:
    """Total per category as rows, over all customers or those matching ``where``."""
    chosen = customers if where is None else customers.where(where)
    totals = chosen.agg(*[exact_sum(c).alias(c) for c in spend])
    return columns_to_rows(totals, spend, "category", "total")


def spend_per_customer(customers: DataFrame, by: str, spend: Sequence[str]) -> DataFrame:
    """Mean total spend of a customer in each group."""
    return customers.groupBy(by).agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.try_divide(exact_sum(row_total(spend)), F.count(F.lit(1))), 2).alias("avg_total_spend"))


def channel_mix(customers: DataFrame, by: str, channels: Sequence[str]) -> DataFrame:
    return customers.groupBy(by).agg(*[F.sum(c).alias(c) for c in channels])


def repeat_buyers(customers: DataFrame, purchases: Sequence[str]) -> DataFrame:
    """Customers with exactly one purchase and with more."""
    bought = row_total(purchases)
    return customers.agg(F.count_if(bought == 1).alias("one_time"), F.count_if(bought > 1).alias("repeat"))


def loyalty_targets(customers: DataFrame, spend: Sequence[str], purchases: Sequence[str], max_recency: int = 25,
                    min_purchases: int = 18, min_spend: float = 1500) -> DataFrame:
    """Recent, frequent, high-spending customers."""
    return customers.withColumns({"purchases": row_total(purchases), "spend": row_total(spend)}).where(
        (F.col("recency_days") < max_recency) & (F.col("purchases") > min_purchases) & (F.col("spend") > min_spend))


def age_band(age: Column) -> Column:
    return ladder([(age <= 30, "Young"), (age <= 60, "Middle-aged"), (age > 60, "Old")])


def spend_by_age_band(customers: DataFrame, as_of: str, spend: Sequence[str]) -> DataFrame:
    age = F.year(F.lit(as_of).cast("date")) - F.col("birth_year")
    return customers.withColumn("age_band", age_band(age)).groupBy("age_band").agg(
        F.count(F.lit(1)).alias("customers"), exact_sum(row_total(spend)).alias("total_spend"))


def churn_risk(customers: DataFrame, spend: Sequence[str], purchases: Sequence[str], by: str) -> DataFrame:
    """Customers below the first quartile in both purchases and spend, counted per group."""
    totals = durable(customers.select(by, row_total(purchases).alias("purchases"), row_total(spend).alias("spend")))
    q_buy = quantile_struct(totals, "purchases", {"q": 0.25})["q"]
    q_spend = quantile_struct(totals, "spend", {"q": 0.25})["q"]
    at_risk = totals.where((F.col("purchases") < q_buy) & (F.col("spend") < q_spend))
    return at_risk.groupBy(by).agg(F.count(F.lit(1)).alias("at_risk_customers"))


def segment_profile(customers: DataFrame, by: str, spend: Sequence[str], purchases: Sequence[str], deals: str
                    ) -> DataFrame:
    """Mean purchase frequency, median spend and deal use per segment, most deal-responsive first flagged."""
    totals = durable(customers.select(by, deals, row_total(purchases).alias("purchases"), row_total(spend).alias("spend")))
    medians = exact_quantiles(totals, "spend", {"median_spend": 0.5}, keys=[by])
    means = totals.groupBy(by).agg(F.round(F.avg("purchases"), 4).alias("avg_frequency"),
                                   F.sum(deals).alias("deal_purchases"))
    best = means.agg(F.max_by(by, F.struct("deal_purchases", by))).scalar()
    return null_safe_join(means, medians, [by]).withColumns({
        "median_spend": F.round("median_spend", 2), "most_deal_responsive": F.col(by) == best})


def revenue_ranking(customers: DataFrame, by: str, spend: Sequence[str]) -> DataFrame:
    """Revenue per segment and its gap in percent to the leading segment."""
    revenue = customers.groupBy(by).agg(exact_sum(row_total(spend)).alias("revenue"))
    top = revenue.agg(F.max("revenue")).scalar()
    return revenue.withColumn("gap_to_leader_pct", pct(top - F.col("revenue"), F.col("revenue")))


def rfm_scores(customers: DataFrame, key: str = "id", recency: str = "recency_days", frequency: str = "frequency",
               monetary: str = "monetary") -> DataFrame:
    """R by value fifths (recent is 5), F and M by rank fifths, score text and segment."""
    # one narrow row per customer, read by every score below
    scored = with_all_rank_bins(durable(customers), {"f_score": frequency, "m_score": monetary}, [key], 5)
    scored = with_value_bins(scored, recency, 5, [5, 4, 3, 2, 1], "r_score")
    score = F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")])
    return scored.withColumn("rfm_score", score).withColumn(
        "segment", ladder([(F.col("rfm_score") >= low, name) for low, name in RFM_SEGMENTS], RFM_REST))


def rfm_summary(scored: DataFrame, recency: str = "recency_days", frequency: str = "frequency",
                monetary: str = "monetary") -> DataFrame:
    return scored.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg(recency), 2).alias("avg_recency"),
        F.round(F.avg(frequency), 2).alias("avg_frequency"),
        F.round(F.try_divide(exact_sum(monetary), F.count(monetary)), 2).alias("avg_monetary"))


def purchase_spend_fit(customers: DataFrame, spend: Sequence[str], purchases: Sequence[str]) -> DataFrame:
    """Correlation and least-squares line of spend on purchases."""
    x, y = row_total(purchases).cast("double"), row_total(spend)
    return customers.agg(F.round(F.corr(x, y), 6).alias("pearson_r"), F.round(F.regr_slope(y, x), 4).alias("slope"),
                         F.round(F.regr_intercept(y, x), 2).alias("intercept"))
