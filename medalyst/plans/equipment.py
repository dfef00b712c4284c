"""Equipment effectiveness: availability, performance, quality and their product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.functions.columns import exact_avg, exact_sum
from medalyst.operators.ordered import running_total
from medalyst.operators.relational import with_share


def effectiveness(runs: DataFrame, by: str = "machine") -> DataFrame:
    """All four ratios per machine from one aggregation of its runs.

    ``runs`` has planned and run minutes, the ideal minutes per unit, units made and units rejected.
    """
    s = runs.groupBy(by).agg(
        exact_sum("planned_min", 4).alias("planned_min"), exact_sum("run_min", 4).alias("run_min"),
        exact_sum(F.col("ideal_min") * F.col("units"), 6).alias("ideal_total"),
        exact_sum("units").alias("units"), exact_sum("rejects").alias("rejects"))
    a = F.try_divide("run_min", "planned_min")
    p = F.try_divide("ideal_total", "run_min")
    q = F.try_divide(F.col("units") - F.col("rejects"), "units")
    return s.select(by, F.round(a, 4).alias("availability"), F.round(p, 4).alias("performance"),
                    F.round(q, 4).alias("quality"), F.round(F.lit(1.0) - q, 4).alias("rejection_rate"),
                    F.round(a * p * q, 4).alias("oee"))


def underperformers(ratios: DataFrame, by: str = "machine") -> DataFrame:
    """Machines below the plant's mean effectiveness."""
    mean = ratios.agg(F.avg("oee")).scalar()
    return ratios.where(F.col("oee") < mean).select(by, "oee")


def downtime_pareto(stops: DataFrame, by: str, minutes: str, top_share: float = 70.0) -> DataFrame:
    """Downtime per cause, largest first, with cumulative percent and the causes that make up ``top_share``."""
    causes = stops.groupBy(by).agg(exact_sum(minutes).alias("downtime_min")).withColumn(
        "_desc", -F.col("downtime_min"))
    running = running_total(causes, "downtime_min", ["_desc", by], out="_cum")
    whole = causes.agg(F.sum("downtime_min")).scalar()
    before = (F.col("_cum") - F.col("downtime_min")) / whole * 100
    return running.select(
        by, F.round("downtime_min", 2).alias("downtime_min"),
        F.round(F.col("_cum") / whole * 100, 2).alias("cumulative_pct"),
        (before < top_share).alias("top_contributor"))


def downtime_mix(stops: DataFrame, by: str, minutes: str) -> DataFrame:
    return with_share(stops.groupBy(by).agg(exact_sum(minutes).alias("downtime_min")), "downtime_min", "pct")


def cycle_variability(runs: DataFrame, by: str, cycle: str) -> DataFrame:
    """Spread of the cycle time per shift, absolute and relative to its mean."""
    mean, sd = F.avg(cycle), F.stddev_samp(cycle)
    return runs.groupBy(by).agg(F.round(mean, 4).alias("mean_cycle"), F.round(sd, 4).alias("std_cycle"),
                                F.round(F.try_divide(sd, mean), 4).alias("cv"))


def bottleneck(runs: DataFrame, by: str, cycle: str) -> DataFrame:
    """The machine with the longest mean cycle."""
    means = runs.groupBy(by).agg(F.round(exact_avg(cycle, 6), 6).alias("mean_cycle"))
    return means.orderBy(F.desc("mean_cycle"), by).limit(1)
