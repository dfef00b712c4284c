"""Subscriber analytics: growth, retention, conversion, revenue, engagement and targeting.

Tables: ``subscribers`` has one row per user and platform, ``engagement`` one row
per user and device joined with the subscriber's attributes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalyst.functions.columns import (calendar_months, clip, exact_avg, exact_sum, ladder, lookup, month_start,
                                        pct, thirty_day_months)
from medalyst.operators.cleaning import min_max_scaled
from medalyst.operators.dedupe import top_per_key
from medalyst.operators.quantiles import exact_quantiles, quantile_struct, within_fences
from medalyst.operators.relational import detail_and_overall, with_share
from medalyst.operators.reshape import columns_to_rows, rows_to_columns, step_grid

# Fixed values of the subscriber model.
PLAN_RANK = {"Free": 0, "Basic": 1, "Premium": 2, "VIP": 3}
PLAN_WEIGHT = {"Free": 1, "Basic": 2, "Premium": 3, "VIP": 4}
PAID_PLANS = ("Basic", "Premium", "VIP")
PLAN_PRICES = {("A", "Free"): 0, ("A", "Basic"): 69, ("A", "Premium"): 129,
               ("B", "Free"): 0, ("B", "VIP"): 159, ("B", "Premium"): 359}
TARGET_WEIGHT = {"Free": 1.0, "Basic": 0.8, "Premium": 0.5, "VIP": 0.3}
RETENTION_DAYS = (30, 60, 90)


# --- growth -------------------------------------------------------------------

def pct_change(value: str, order: Sequence[str], keys: Sequence[str] = (), first: float | None = 0.0,
               digits: int | None = 2) -> Column:
    """Percent change from the previous row of an aggregated series (a few rows per key)."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    change = F.try_divide((F.col(value) - before) * 100.0, before)
    change = change if first is None else F.coalesce(change, F.lit(first))
    return change if digits is None else F.bround(change, digits)


def monthly_growth(subscribers: DataFrame, by_year: bool = True) -> DataFrame:
    """New subscribers per platform and month with their month-over-month change.

    Without ``by_year`` the months of different years fall together.
    """
    month = month_start("subscription_date") if by_year else F.month("subscription_date")
    counts = subscribers.where("subscription_date is not null").groupBy("platform", month.alias("month")).agg(
        F.count(F.lit(1)).alias("new_subscribers"))
    return counts.withColumn("growth_pct", pct_change("new_subscribers", ["month"], ["platform"]))


def acquisition_by_tier(subscribers: DataFrame) -> DataFrame:
    """Per tier: mean and total monthly sign-ups, mean growth and yearly compound growth."""
    counts = subscribers.where("subscription_date is not null").groupBy(
        "city_tier", month_start("subscription_date").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    changes = counts.withColumn("change", pct_change("n", ["month"], ["city_tier"], digits=None))
    per_tier = changes.groupBy("city_tier").agg(
        F.avg("n").alias("mean_n"), F.sum("n").alias("total_subs"), F.avg("change").alias("mean_change"),
        F.min_by("n", "month").alias("first_n"), F.max_by("n", "month").alias("last_n"),
        F.count(F.lit(1)).alias("months"))
    compound = (F.pow(F.try_divide("last_n", "first_n"), F.lit(12.0) / F.col("months")) - 1) * 100
    return per_tier.select(
        "city_tier", F.bround("mean_n", 2).alias("avg_monthly_subs"), "total_subs",
        F.bround("mean_change", 2).alias("avg_growth_pct"),
        F.when(F.col("months") < 2, F.lit(0.0)).otherwise(F.bround(compound, 2)).alias("cagr_pct"))


# --- retention and conversion ---------------------------------------------------

def retention(subscribers: DataFrame, by: Sequence[str], days: Sequence[int] = RETENTION_DAYS,
              denominator: str = "all") -> DataFrame:
    """Percent of users still on their plan after so many days.

    ``denominator="changed"`` leaves out users who never changed plan, whose active days count as zero otherwise.
    """
    users = subscribers if denominator == "all" else subscribers.where("plan_change_date is not null")
    active = F.greatest(F.coalesce(F.datediff("plan_change_date", "subscription_date"), F.lit(0)), F.lit(0))
    shares = [F.bround(F.count_if(F.col("active_days") >= d) * 100.0 / F.count(F.lit(1)), 2).alias(f"retention_{d}")
              for d in days]
    return users.withColumn("active_days", active).groupBy(*by).agg(*shares)


def retention_long(shares: DataFrame, by: Sequence[str], days: Sequence[int] = RETENTION_DAYS) -> DataFrame:
    return columns_to_rows(shares, [f"retention_{d}" for d in days], "period", "retention_pct", keep=by)


def early_upgrades(subscribers: DataFrame, within_days: int = 90) -> DataFrame:
    """Free users who moved to a paid plan in time."""
    waited = F.datediff("plan_change_date", "subscription_date")
    return subscribers.where((F.col("subscription_plan") == "Free") & F.col("new_subscription_plan").isin(*PAID_PLANS)
                             & (waited <= within_days))


def conversion(subscribers: DataFrame, within_days: int = 90) -> DataFrame:
    """Conversion of free users by age group and tier, in one pass over them."""
    waited = F.datediff("plan_change_date", "subscription_date")
    converted = F.col("new_subscription_plan").isin(*PAID_PLANS) & (waited <= within_days)
    return subscribers.where("subscription_plan = 'Free'").groupBy("age_group", "city_tier").agg(
        F.count(F.lit(1)).alias("total_free"), F.count_if(converted).alias("paid_in_time")).withColumn(
        "conversion_pct", pct("paid_in_time", "total_free", half_even=True))


def conversion_grid(rates: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """The same rates as an age by tier grid."""
    return rows_to_columns(rates, ["age_group"], "city_tier", tiers, F.max("conversion_pct"))


def boosted_retention(subscribers: DataFrame, platform: str, boost: float = 1.15) -> DataFrame:
    """Monthly retention per platform, and the same with one platform lifted (never above 1)."""
    monthly = subscribers.where("subscription_date is not null").groupBy(
        "platform", month_start("subscription_date").alias("month")).agg(
        (F.lit(1.0) - F.avg("inactivity_flag")).alias("rate"))
    lifted = F.when(F.col("platform") == platform, F.least(F.col("rate") * boost, F.lit(1.0))).otherwise(F.col("rate"))
    uplift = F.coalesce(F.try_divide((lifted - F.col("rate")) * 100, "rate"), F.lit(0.0))
    return monthly.select("platform", "month", F.round("rate", 6).alias("retention_rate"),
                          F.round(lifted, 6).alias("retention_boosted"), F.round(uplift, 4).alias("uplift_pct"))


def uplift_value(boosted: DataFrame, subscribers: DataFrame, platform: str, cohort_plan: str) -> DataFrame:
    """Yearly value of the lift: mean uplift x 12 x mean price x cohort size."""
    lift = boosted.where(F.col("platform") == platform).agg(F.avg("uplift_pct")).scalar()
    mine = subscribers.where(F.col("platform") == platform)
    return mine.agg(F.avg("plan_price").alias("price"),
                    F.count_if(F.col("subscription_plan") == cohort_plan).alias("cohort")).select(
        F.round(lift, 4).alias("mean_uplift_pct"), F.round("price", 4).alias("mean_price"), "cohort",
        F.round(lift / 100 * 12 * F.col("price") * F.col("cohort"), 2).alias("uplift_value"))


# --- engagement -----------------------------------------------------------------

def device_engagement(engagement: DataFrame) -> DataFrame:
    """Users, mean and spread of watch time per tier and device, outliers removed."""
    kept = within_fences(engagement, "watch_mins").dropna(subset=["city_tier", "device_type"])
    return kept.groupBy("city_tier", "device_type").agg(
        F.count(F.lit(1)).alias("user_count"), F.bround(exact_avg("watch_mins"), 2).alias("avg_watch"),
        F.bround(F.stddev_samp("watch_mins"), 2).alias("std_watch")).withColumn(
        "revenue_potential", F.bround(F.col("user_count") * F.col("avg_watch") * 0.01, 2))


def device_grid(cells: DataFrame, devices: Sequence[str]) -> DataFrame:
    return rows_to_columns(cells, ["city_tier"], "device_type", devices, F.max("avg_watch"), fill=0.0)


def cell_uplift(cells: DataFrame, target: tuple[str, str], base: tuple[str, str]) -> DataFrame:
    """Percent by which one (tier, device) cell's mean exceeds another's; 0 without a base."""
    at = lambda cell: F.coalesce(F.max(F.when(
        (F.col("city_tier") == cell[0]) & (F.col("device_type") == cell[1]), F.col("avg_watch"))), F.lit(0.0))
    return cells.agg(at(target).alias("target_mean"), at(base).alias("base_mean")).withColumn(
        "uplift_pct", F.coalesce(F.round(F.try_divide(
            (F.col("target_mean") - F.col("base_mean")) * 100, "base_mean"), 2), F.lit(0.0)))


def labelled_segments(engagement: DataFrame, rules: Sequence[tuple[Column, str]], default: str = "Low-Engagement Users"
                      ) -> DataFrame:
    """Watch time per rule-labelled segment and its share of the platform."""
    tagged = engagement.withColumn("segment", ladder(rules, default))
    totals = tagged.groupBy("platform", "segment").agg(exact_sum("watch_mins").alias("watch_mins"))
    return with_share(totals, "watch_mins", "pct_of_platform", ["platform"])


def inactivity_risk(engagement: DataFrame) -> DataFrame:
    """Mean of a watch-time quartile risk and the scaled days since the last plan change."""
    newest = engagement.agg(F.max("plan_change_date")).scalar()
    q = quantile_struct(engagement, "watch_mins", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    watch = F.col("watch_mins")
    watch_risk = ladder([(watch <= q["q1"], 1.0), (watch <= q["q2"], 0.75), (watch <= q["q3"], 0.5)], 0.0)
    days = F.coalesce(F.datediff(newest, "plan_change_date"), F.lit(0))
    scaled = min_max_scaled(engagement.withColumn("days_since_change", days), "days_since_change", "days_risk")
    return scaled.withColumn("watch_risk", watch_risk).withColumn(
        "inactivity_risk", F.bround((F.col("watch_risk") + F.col("days_risk")) / 2, 2))


def reengagement(risk: DataFrame, age_group: str, prob: float = 0.2, factor: float = 0.7) -> DataFrame:
    """Mean risk reduction when the riskiest users of an age group are won back."""
    group = risk.where(F.col("age_group") == age_group)
    threshold = quantile_struct(group, "inactivity_risk", {"t": prob})["t"]
    chosen = group.where(F.col("inactivity_risk") >= threshold)
    adjusted = F.bround(F.col("inactivity_risk") * factor, 2)
    return chosen.agg(F.count(F.lit(1)).alias("at_risk_users"),
                      F.round(exact_avg("inactivity_risk") - exact_avg(adjusted), 4).alias("mean_reduction"))


def activity_states(engagement: DataFrame) -> DataFrame:
    """Inactive (never active or nothing watched), Active (upper quartile of watchers) or Low Watch; share of each."""
    watch = F.col("watch_mins")
    high = quantile_struct(engagement.where(watch > 0), "watch_mins", {"h": 0.75})["h"]
    state = ladder([(F.col("last_active_date").isNull() | (watch == 0), "Inactive"), (watch >= high, "Active")],
                   "Low Watch")
    counts = engagement.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("users"))
    return with_share(counts, "users", "pct")


def laptop_switchers(engagement: DataFrame, device: str = "Laptop") -> DataFrame:
    """Users of ``device`` and of others: watch time on the others (before) and on it (after)."""
    on_device = F.col("device_type") == device
    per_user = engagement.groupBy("user_id").agg(
        exact_sum(F.when(~on_device, F.col("watch_mins"))).alias("pre"),
        exact_sum(F.when(on_device, F.col("watch_mins"))).alias("post"),
        F.min("city_tier").alias("city_tier"))
    return per_user.where("pre > 0 and post > 0").withColumn("diff", F.round(F.col("post") - F.col("pre"), 2))


def switcher_summary(switchers: DataFrame) -> DataFrame:
    return switchers.groupBy("city_tier").agg(
        F.count(F.lit(1)).alias("users"), F.bround(exact_avg("diff"), 2).alias("mean_diff"),
        F.bround(F.stddev_samp("diff"), 2).alias("std_diff"))


# --- revenue ----------------------------------------------------------------------

def priced(subscribers: DataFrame) -> DataFrame:
    """Attach the list price by platform and plan; unknown combinations cost 0."""
    table = {f"{p}|{plan}": price for (p, plan), price in PLAN_PRICES.items()}
    return subscribers.withColumn(
        "plan_price", lookup(F.concat_ws("|", "platform", "subscription_plan"), table, 0).cast("double"))


def with_plan_move(subscribers: DataFrame) -> DataFrame:
    """Upgrade, Downgrade or No Change by plan rank; a missing new plan is no change."""
    now = lookup("subscription_plan", PLAN_RANK, 0)
    then = F.coalesce(lookup("new_subscription_plan", PLAN_RANK), now)
    return subscribers.withColumn("plan_move", ladder([(then > now, "Upgrade"), (then < now, "Downgrade")], "No Change"))


def with_downgrade_flag(subscribers: DataFrame) -> DataFrame:
    """1 when the plan was changed on a known date to a lower known plan."""
    rank = {k.lower(): v for k, v in PLAN_RANK.items()}
    now, then = (lookup(F.lower(F.trim(F.col(c))), rank) for c in ("subscription_plan", "new_subscription_plan"))
    moved = F.col("plan_change_date").isNotNull() & (then < now)
    return subscribers.withColumn("downgrade_flag", F.coalesce(moved.cast("int"), F.lit(0)))


def prorated(subscribers: DataFrame, as_of: str | None = None) -> DataFrame:
    """Price times months active (thirty-day months, two decimals).

    A user without a last active date is still active: with ``as_of`` the open
    interval ends there, without it such a user earns nothing.
    """
    end = F.col("last_active_date") if as_of is None else F.coalesce("last_active_date", F.lit(as_of).cast("date"))
    days = F.greatest(F.coalesce(F.datediff(end, "subscription_date"), F.lit(0)), F.lit(0))
    return priced(subscribers).withColumn("active_months", F.bround(days / 30, 2)).withColumn(
        "prorated_revenue", clip(F.col("active_months") * F.col("plan_price"), low=0.0))


def revenue_by_plan(revenue: DataFrame) -> DataFrame:
    """Per platform, tier and plan, with Overall rows beside (not inside) the totals."""
    return detail_and_overall(revenue, "platform", ["city_tier", "subscription_plan"],
                              [exact_sum("prorated_revenue").alias("prorated_revenue")])


def high_watch_share(revenue: DataFrame, tier: str) -> DataFrame:
    """Percent of revenue from users of a tier above the median watch time."""
    median = quantile_struct(revenue, "watch_mins", {"m": 0.5})["m"]
    chosen = (F.col("city_tier") == tier) & (F.col("watch_mins") > median)
    return revenue.agg(
        exact_sum(F.when(chosen, F.col("prorated_revenue")).otherwise(0)).alias("segment_revenue"),
        exact_sum("prorated_revenue").alias("total_revenue")).withColumn(
        "share_pct", F.coalesce(pct("segment_revenue", "total_revenue"), F.lit(0.0)))


def cohort_revenue_curve(subscribers: DataFrame, cohort: Sequence[str], as_of: str, months: int = 12) -> DataFrame:
    """Revenue per month of age: users of at least that tenure times the cohort's mean price.

    A tenure histogram is summed from the top (at most ``months`` rows per
    cohort), so users are read once rather than once per month.
    """
    tenure = F.least(calendar_months("subscription_date", F.lit(as_of).cast("date")), F.lit(months - 1))
    hist = subscribers.where("subscription_date is not null").withColumn("month", tenure).where("month >= 0").groupBy(
        *cohort, "month").agg(F.count(F.lit(1)).alias("n"))
    prices = subscribers.where("subscription_date is not null").groupBy(*cohort).agg(F.avg("plan_price").alias("price"))
    grid = prices.select(*cohort, "price", F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("month"))
    from_top = Window.partitionBy(*cohort).orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, 0)
    filled = grid.join(hist, [*cohort, "month"], "left").withColumn("retained", F.sum(F.coalesce("n", F.lit(0))).over(from_top))
    return filled.select(*cohort, "month", "retained", F.round(F.col("retained") * F.col("price"), 2).alias("revenue"))


def lifetime_value(curve: DataFrame, cohort: Sequence[str]) -> DataFrame:
    return curve.groupBy(*cohort).agg(exact_sum("revenue").alias("ltv"))


def synergy_scenario(subscribers: DataFrame, platform: str, lift: float = 1.2) -> DataFrame:
    """Yearly revenue (halved for downgraders) before and after one platform's watch time rises."""
    yearly = F.when(F.col("plan_move") == "Downgrade", F.col("plan_price") * 0.5 * 12).otherwise(F.col("plan_price") * 12)
    after = F.when(F.col("platform") == platform, yearly * lift).otherwise(yearly)
    return subscribers.agg(exact_sum(yearly).alias("revenue_before"), exact_sum(after).alias("revenue_after")).withColumn(
        "increase_pct", pct(F.col("revenue_after") - F.col("revenue_before"), F.col("revenue_before")))


def value_tiers(subscribers: DataFrame, value: str = "plan_price") -> DataFrame:
    """Users above the upper and at or below the lower quartile of ``value``, with platform shares."""
    q = quantile_struct(subscribers, value, {"lo": 0.25, "hi": 0.75})
    tier = ladder([(F.col(value) > q["hi"], "high"), (F.col(value) <= q["lo"], "low")])
    counts = subscribers.withColumn("value_tier", tier).where("value_tier is not null").groupBy(
        "value_tier", "platform").agg(F.count(F.lit(1)).alias("users"))
    return with_share(counts, "users", "pct_of_tier", ["value_tier"])


def quartile_revenue(df: DataFrame, by: str, price: str = "plan_price") -> DataFrame:
    """Users, mean and total revenue per quartile of ``by``, and the gap between top and bottom."""
    q = quantile_struct(df, by, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    x = F.col(by)
    tagged = df.where(x.isNotNull()).withColumn("quartile", ladder(
        [(x <= q["q1"], "Q1"), (x <= q["q2"], "Q2"), (x <= q["q3"], "Q3")], "Q4"))
    stats = tagged.groupBy("quartile").agg(F.count(F.lit(1)).alias("users"), F.bround(exact_avg(price), 2).alias("mean_price"))
    ends = stats.agg((F.max(F.when(F.col("quartile") == "Q4", F.col("mean_price")))
                      - F.max(F.when(F.col("quartile") == "Q1", F.col("mean_price"))))).scalar()
    return stats.withColumns({"total_revenue": F.round(F.col("mean_price") * F.col("users"), 2),
                              "top_bottom_gap": F.round(ends, 2)})


def cohort_decay(subscribers: DataFrame, cohort: str, as_of: str) -> DataFrame:
    """Revenue by thirty-day age of the subscription, gaps filled with zero."""
    end = F.lit(as_of).cast("date")
    aged = subscribers.where(F.col("subscription_date") < end).withColumn(
        "age_months", F.greatest(thirty_day_months("subscription_date", end), F.lit(0)))
    monthly = aged.groupBy(cohort, "age_months").agg(exact_sum("plan_price").alias("revenue"))
    return step_grid(monthly, [cohort], "age_months", "revenue")


def acquired_between(subscribers: DataFrame, platform: str, year: int, months: tuple[int, int],
                     fallback: tuple[int, int], wanted_users: int = 50) -> DataFrame:
    """A platform's users acquired in some months of a year, or in the wider ``fallback`` months if those hold fewer than ``wanted_users``.

    ``cohort_range`` tells which months they are and ``range_users`` how many the narrow months hold.
    """
    mine = subscribers.where((F.col("platform") == platform) & (F.year("subscription_date") == year))
    in_months = lambda span: F.month("subscription_date").between(*span)
    narrow = mine.agg(F.count_if(in_months(months))).scalar()
    told = lambda span: F.lit(f"{span[0]}-{span[1]}")
    picked = mine.withColumns({"range_users": narrow, "cohort_range": F.when(narrow >= wanted_users, told(months)).otherwise(told(fallback))})
    return picked.where(F.when(F.col("range_users") >= wanted_users, in_months(months)).otherwise(in_months(fallback)))


# --- mix, funnel, overlap, targeting ------------------------------------------------

def segment_weights(subscribers: DataFrame, overall: str = "Merged") -> DataFrame:
    """Plan-weighted size of each age and tier segment, per platform and merged."""
    weighted = subscribers.withColumn("weight", lookup("subscription_plan", PLAN_WEIGHT, 1))
    return detail_and_overall(weighted, "platform", ["age_group", "city_tier"],
                              [F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("users")], overall)


def diversity(weights: DataFrame) -> DataFrame:
    """Simpson and Shannon diversity of the segment weights per platform."""
    shares = with_share(weights, "weight", "p", ["platform"], scale=1.0, digits=None)
    entropy = F.coalesce(-F.sum(F.when(F.col("p") > 0, F.col("p") * F.log2("p"))), F.lit(0.0))
    return shares.groupBy("platform").agg(
        F.round(F.lit(1.0) - F.sum(F.col("p") * F.col("p")), 6).alias("simpson"),
        F.round(entropy, 6).alias("shannon"), F.count(F.lit(1)).alias("segments"),
        F.sum("users").alias("users"), F.sum("weight").alias("total_weight"))


def concentration(weights: DataFrame, k: int = 3, limit: float = 0.5) -> DataFrame:
    """Share of the ``k`` heaviest segments of each platform, flagged above ``limit``."""
    shares = with_share(weights, "weight", "p", ["platform"], scale=1.0, digits=None)
    top = top_per_key(shares, ["platform"], [F.desc("p"), F.asc("age_group"), F.asc("city_tier")], k)
    return top.groupBy("platform").agg(F.round(F.sum("p"), 6).alias("top_share")).withColumn(
        "concentrated", F.col("top_share") > limit)


def diversity_synergy(scores: DataFrame, overall: str = "Merged") -> DataFrame:
    """Merged entropy minus the mean of the separate platforms."""
    merged = F.max(F.when(F.col("platform") == overall, F.col("shannon")))
    separate = F.avg(F.when(F.col("platform") != overall, F.col("shannon")))
    return scores.agg(F.round(merged, 6).alias("merged_entropy"), F.round(separate, 6).alias("mean_entropy"),
                      F.round(merged - separate, 6).alias("synergy"))


FUNNEL = ("signup", "paid", "active", "high_engagement")


def funnel(users: DataFrame, active_since: str) -> DataFrame:
    """Sign-up, paid, active and highly engaged counts with step and overall rates.

    The high-engagement limit is the upper quartile of active users; with none active nobody reaches it.
    """
    flagged = users.withColumn("_active", F.coalesce(
        (F.col("watch_mins") > 0) & (F.col("last_active_date") >= F.lit(active_since).cast("date")), F.lit(False)))
    limit = quantile_struct(flagged.where("_active"), "watch_mins", {"h": 0.75})["h"]
    stages = [F.count(F.lit(1)), F.count_if(F.col("plan_price") > 0), F.count_if("_active"),
              F.count_if(F.col("watch_mins") >= limit)]
    counts = flagged.agg(*[s.alias(name) for s, name in zip(stages, FUNNEL)])
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("stage"), F.col(n).alias("users"))
                     for i, n in enumerate(FUNNEL)])
    steps = counts.select(F.explode(rows).alias("r"), F.col("signup").alias("_all")).select("r.*", "_all")
    order = Window.orderBy("step")                      # four rows
    before = F.lag("users").over(order)
    return steps.select(
        "step", "stage", "users",
        F.bround(F.try_divide(F.col("users") * 100.0, "_all"), 1).alias("pct_of_signup"),
        F.bround(F.try_divide(F.col("users") * 100.0, before), 1).alias("step_rate_pct"),
        F.bround(F.coalesce(F.try_divide((F.col("users") - before) * 100.0, before), F.lit(100.0)), 1).alias("step_change_pct"),
        F.coalesce(F.abs(F.col("users") - before), F.lit(0)).alias("dropoff"))


def cohort_overlap(first: DataFrame, second: DataFrame, key: str = "user_id", value: str = "watch_mins") -> DataFrame:
    """Users and watch minutes only in the first cohort, only in the second, and in both."""
    sums = [df.groupBy(key).agg(exact_sum(value).alias(n)) for df, n in ((first, "v1"), (second, "v2"))]
    both = sums[0].join(sums[1], key, "full")
    where = ladder([(F.col("v2").isNull(), "first only"), (F.col("v1").isNull(), "second only")], "both")
    joint = F.coalesce("v1", F.lit(0.0)) + F.coalesce("v2", F.lit(0.0))
    return both.groupBy(where.alias("found_in")).agg(F.count(F.lit(1)).alias("users"), exact_sum(joint).alias("watch_mins"))


def target_scores(users: DataFrame, weights: Mapping[str, float] = TARGET_WEIGHT, missing_weight: float = 0.5) -> DataFrame:
    """High score for light viewers on valuable plans."""
    top = users.agg(F.max("watch_mins")).scalar()
    unused = F.when(top == 0, F.lit(0.0)).otherwise(F.lit(1.0) - F.col("watch_mins") / (top + 1))
    return users.withColumn("target_score", unused * lookup("subscription_plan", weights, missing_weight))


def target_grid(scored: DataFrame) -> DataFrame:
    return scored.groupBy("city_tier", "subscription_plan").agg(
        F.round(exact_avg("target_score", 9), 6).alias("mean_score"), F.count(F.lit(1)).alias("users"))


def projected_users(scored: DataFrame, lift: float) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("baseline_users")).withColumn(
        "projected_users", F.floor(F.col("baseline_users") * lift))


def platform_totals(engagement: DataFrame) -> DataFrame:
    """Watch totals and coverage per platform."""
    return engagement.groupBy("platform").agg(
        F.count(F.lit(1)).alias("records"), exact_sum("watch_mins").alias("total_watch"),
        F.round(exact_avg("watch_mins"), 4).alias("mean_watch"), F.countDistinct("city_tier").alias("tiers"),
        F.countDistinct("device_type").alias("devices"))


def move_counts(subscribers: DataFrame) -> DataFrame:
    return with_plan_move(subscribers).groupBy("platform", "plan_move").agg(F.count(F.lit(1)).alias("users"))


def group_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], digits: int = 4) -> DataFrame:
    exact = exact_quantiles(df, value, probs, keys=by)
    return exact.select(*by, *[F.round(c, digits).alias(c) for c in probs])
