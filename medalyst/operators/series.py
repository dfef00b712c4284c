"""Monthly series per key: decomposition, trend forecast, backtest, decay and state moves.

A series here is already aggregated to one row per key and month, so windows
over a key see as many rows as there are months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalyst.functions.columns import exact_sum, month_start
from medalyst.operators.relational import null_safe_join
from medalyst.operators.reshape import month_grid

Z95 = 1.959963984540054


def _summed(value: str, scale: int | None) -> Column:
    """Money is summed in whole units of its last decimal (``scale``); anything else as it is."""
    return F.sum(F.col(value).cast("double")) if scale is None else exact_sum(value, scale)


def monthly_totals(df: DataFrame, keys: Sequence[str], date: str, value: str, shared_span: bool = True, scale: int | None = None) -> DataFrame:
    """Sum per key and month on a gap-free calendar; ``scale`` is the number of decimals of a money column."""
    monthly = df.where(F.col(date).isNotNull()).groupBy(*keys, month_start(date).alias("month")).agg(_summed(value, scale).alias("total"))
    return month_grid(monthly, keys, "month", "total", shared_span)


def indexed(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number the months of each key from 0."""
    return series.withColumn("t", F.row_number().over(Window.partitionBy(*keys).orderBy("month")) - 1)


def decomposed(series: DataFrame, keys: Sequence[str], value: str = "total", period: int = 3) -> DataFrame:
    """Centred moving average, mean seasonal deviation per phase (summing to zero) and the rest."""
    half = period // 2
    order = Window.partitionBy(*keys).orderBy("t")
    around = order.rowsBetween(-half, half)
    t = indexed(series, keys).withColumn("phase", F.col("t") % period)
    trend = F.when(F.count(value).over(around) == period, F.avg(value).over(around))
    t = t.withColumn("trend", trend).withColumn("_dev", F.col(value) - F.col("trend"))
    phases = t.groupBy(*keys, "phase").agg(F.avg("_dev").alias("_s"))
    centre = phases.groupBy(*keys).agg(F.avg("_s").alias("_m"))
    seasonal = null_safe_join(phases, centre, list(keys)).select(*keys, "phase", (F.col("_s") - F.col("_m")).alias("seasonal"))
    return null_safe_join(t, seasonal, [*keys, "phase"]).withColumn(
        "residual", F.col(value) - F.col("trend") - F.col("seasonal")).drop("_dev", "phase")


def _trend(fit: DataFrame, keys: Sequence[str], value: str, min_points: int) -> DataFrame:
    """Per key: level, slope and residual spread, and which ``model`` they are: a flat mean for short or all-zero series, else the trend."""
    y, t = F.col(value).cast("double"), F.col("t").cast("double")
    s = fit.groupBy(*keys).agg(
        F.count(y).alias("points"), F.count_if(y != 0).alias("_nonzero"), F.avg(y).alias("mean"), F.max("t").alias("last_t"),
        F.max("month").alias("last_month"), F.regr_slope(y, t).alias("_b"), F.regr_intercept(y, t).alias("_a"),
        F.regr_syy(y, t).alias("_syy"), F.regr_sxy(y, t).alias("_sxy"))
    use = (F.col("points") >= min_points) & (F.col("_nonzero") > 0) & F.col("_b").isNotNull()
    rest = F.greatest(F.col("_syy") - F.col("_b") * F.col("_sxy"), F.lit(0.0))
    return s.select(
        *keys, F.col("points").alias("n_points"), F.when(use, "trend").otherwise("mean").alias("model"), "mean", "last_t", "last_month",
        F.when(use, F.col("_a")).otherwise(F.col("mean")).alias("level"),
        F.when(use, F.col("_b")).otherwise(F.lit(0.0)).alias("slope"),
        F.when(use, F.sqrt(F.try_divide(rest, F.col("points") - 2))).otherwise(
            F.sqrt(F.try_divide(F.col("_syy"), F.col("points") - 1))).alias("spread"))


def forecast(series: DataFrame, keys: Sequence[str], value: str = "total", steps: int = 3, min_points: int = 6) -> DataFrame:
    """Linear-trend forecast with a 95% residual interval, floored at zero; ``model`` tells where it is the mean instead, ``n_points`` the months."""
    fit = _trend(indexed(series, keys), keys, value, min_points)
    ahead = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    point = F.col("level") + F.col("slope") * (F.col("last_t") + F.col("step"))
    margin = F.coalesce(F.col("spread"), F.lit(0.0)) * Z95
    floor = lambda c: F.greatest(c, F.lit(0.0))
    return ahead.select(*keys, "step", F.add_months("last_month", F.col("step")).alias("month"),
                        floor(point).alias("forecast"), floor(point - margin).alias("low"), floor(point + margin).alias("high"), "model", "n_points")


def backtest(series: DataFrame, keys: Sequence[str], value: str = "total", holdout: int = 2, min_points: int = 6) -> DataFrame:
    """Error of the trend fitted without each key's last ``holdout`` months."""
    t = indexed(series, keys)
    ends = t.groupBy(*keys).agg(F.max("t").alias("_end"))
    split = null_safe_join(t, ends, list(keys)).withColumn("_held", F.col("t") > F.col("_end") - holdout)
    fit = _trend(split.where(~F.col("_held")), keys, value, min_points).select(*keys, "level", "slope", "model", "n_points")
    guess = F.greatest(F.col("level") + F.col("slope") * F.col("t"), F.lit(0.0))
    miss = F.abs(F.col(value) - guess)
    return null_safe_join(split.where("_held"), fit, list(keys)).groupBy(*keys).agg(
        F.avg(miss).alias("mae"), F.avg(F.try_divide(miss * 100, F.abs(F.col(value)))).alias("mape"), F.max("model").alias("model"), F.max("n_points").alias("n_points"))


GRID = tuple((a, b) for a in (0.2, 0.5, 0.8) for b in (0.1, 0.3, 0.6))     # smoothing weights of level and slope that are tried


def _holt(y: Column, alpha: Column, beta: Column) -> Column:
    """Holt's smoothing as a fold over the values: ``base`` at the last one, ``slope``, and the squared one-step errors (``rss``)."""
    first, second = F.get(y, F.lit(0)), F.get(y, F.lit(1))

    def step(state: Column, x: Column) -> Column:
        ahead = state["base"] + state["slope"]
        base = alpha * x + (1 - alpha) * ahead
        return F.struct(base.alias("base"), (beta * (base - state["base"]) + (1 - beta) * state["slope"]).alias("slope"),
                        (state["rss"] + (x - ahead) * (x - ahead)).alias("rss"))

    start = F.struct(second.alias("base"), (second - first).alias("slope"), F.lit(0.0).alias("rss"))
    return F.aggregate(F.slice(y, F.lit(3), F.greatest(F.size(y) - 2, F.lit(0))), start, step)


def _line(y: Column) -> Column:
    """The least-squares line in the same form."""
    n = F.size(y).cast("double")
    add = lambda terms: F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    mean, mid = add(y) / n, (n - 1) / 2
    sxx = n * (n * n - 1) / 12
    slope = F.coalesce(F.try_divide(add(F.transform(y, lambda x, i: (x - mean) * (i - mid))), sxx), F.lit(0.0))
    rss = add(F.transform(y, lambda x, i: F.pow(x - mean - slope * (i - mid), F.lit(2.0))))
    return F.struct((mean + slope * mid).alias("base"), slope.alias("slope"), rss.alias("rss"))


def _flat(y: Column) -> Column:
    mean = F.aggregate(y, F.lit(0.0), lambda a, x: a + x) / F.size(y)
    return F.struct(mean.alias("base"), F.lit(0.0).alias("slope"), F.aggregate(y, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)).alias("rss"))


def _miss(fit: Column, held: Column) -> Column:
    """Mean absolute error of a fit's continuation over the held-out values; infinite where there is no fit."""
    total = F.aggregate(F.transform(held, lambda x, i: F.abs(x - F.greatest(fit["base"] + fit["slope"] * (i + 1), F.lit(0.0)))), F.lit(0.0), lambda a, x: a + x)
    return F.coalesce(F.try_divide(total, F.size(held)), F.lit(float("inf")))


def chosen_forecast(series: DataFrame, keys: Sequence[str], value: str = "total", steps: int = 3, holdout: int = 2) -> DataFrame:
    """Forecast by the model that continues a series best: the mean, the linear trend or Holt's smoothing, fitted without the last ``holdout`` months.

    ``model``, ``holdout_mae``, ``alpha`` and ``beta`` tell the choice, ``n_points`` the months. A series is one array of months, so one grouped
    aggregation does all. A series too short to hold months out, or to fit a model on the rest, leaves that model out; the mean remains.
    """
    months = series.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("month", F.col(value).cast("double").alias("y")))).alias("_s"))
    s = months.select(*keys, F.transform("_s", lambda x: x["y"]).alias("_y"), F.element_at("_s", -1)["month"].alias("_last"), F.size("_s").cast("bigint").alias("n_points"))
    n = F.col("n_points").cast("int")
    train = F.slice("_y", F.lit(1), F.greatest(n - holdout, F.lit(0)))
    s = s.withColumns({"_train": train, "_held": F.slice("_y", F.greatest(n - holdout, F.lit(0)) + 1, F.lit(holdout))})
    enough = lambda k: F.size("_train") >= k
    grid = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta")) for a, b in GRID])
    tried = F.transform(grid, lambda g: F.struct(_miss(_holt(F.col("_train"), g["alpha"], g["beta"]), F.col("_held")).alias("miss"), g["alpha"].alias("alpha"), g["beta"].alias("beta")))
    s = s.withColumn("_best", F.array_min(tried))
    none = F.lit(float("inf"))
    options = F.array(F.struct(F.when(enough(1), _miss(_flat(F.col("_train")), F.col("_held"))).otherwise(none).alias("miss"), F.lit(0).alias("rank"), F.lit("mean").alias("model")),
                      F.struct(F.when(enough(3), _miss(_line(F.col("_train")), F.col("_held"))).otherwise(none).alias("miss"), F.lit(1).alias("rank"), F.lit("trend").alias("model")),
                      F.struct(F.when(enough(3), F.col("_best.miss")).otherwise(none).alias("miss"), F.lit(2).alias("rank"), F.lit("holt").alias("model")))
    s = s.withColumn("_pick", F.array_min(options)).withColumn("model", F.col("_pick.model"))
    is_holt = F.col("model") == "holt"
    s = s.withColumn("_fit", F.when(is_holt, _holt(F.col("_y"), F.col("_best.alpha"), F.col("_best.beta"))).when(F.col("model") == "trend", _line(F.col("_y"))).otherwise(_flat(F.col("_y"))))
    spread = F.sqrt(F.greatest(F.coalesce(F.try_divide(F.col("_fit.rss"), F.col("n_points") - F.when(F.col("model") == "mean", 1).otherwise(2)), F.lit(0.0)), F.lit(0.0))) * Z95
    ahead = s.withColumn("_spread", spread).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    point = F.col("_fit.base") + F.col("_fit.slope") * F.col("step")
    floor = lambda c: F.greatest(c, F.lit(0.0))
    return ahead.select(*keys, "step", F.add_months("_last", F.col("step")).alias("month"), floor(point).alias("forecast"), floor(point - F.col("_spread")).alias("low"),
                        floor(point + F.col("_spread")).alias("high"), "model", F.nullif("_pick.miss", none).alias("holdout_mae"),
                        F.when(is_holt, F.col("_best.alpha")).alias("alpha"), F.when(is_holt, F.col("_best.beta")).alias("beta"), "n_points")


def growth_against_history(series: DataFrame, ahead: DataFrame, keys: Sequence[str], value: str = "total", scale: int | None = None) -> DataFrame:
    """Mean forecast against the historical mean, in percent, and the next month's forecast."""
    past = series.groupBy(*keys).agg(F.try_divide(_summed(value, scale), F.count(value)).alias("history_mean"))
    future = ahead.groupBy(*keys).agg(F.avg("forecast").alias("forecast_mean"),
                                      F.max(F.when(F.col("step") == 1, F.col("forecast"))).alias("next_month"))
    return null_safe_join(past, future, list(keys)).withColumn(
        "growth_pct", F.try_divide((F.col("forecast_mean") - F.col("history_mean")) * 100, "history_mean"))


def fastest_growing(growth: DataFrame, key: str) -> DataFrame:
    """The fastest growing key and the next month's total over all keys."""
    return growth.agg(F.max_by(key, F.struct("growth_pct", key)).alias("top_group"), F.max("growth_pct").alias("growth_pct"),
                      F.sum("next_month").alias("next_month_total"))


def decay_fit(curve: DataFrame, cohort: Sequence[str], age: str, value: str) -> DataFrame:
    """Exponential decay a*exp(-b*age) fitted on the log of the positive values."""
    y, x = F.log(F.col(value)), F.col(age).cast("double")
    fit = curve.where(F.col(value) > 0).groupBy(*cohort).agg(
        F.count(F.lit(1)).alias("points"), F.exp(F.regr_intercept(y, x)).alias("a"), (-F.regr_slope(y, x)).alias("b"),
        F.regr_r2(y, x).alias("r2"))
    return fit.where("points >= 2").withColumn("half_life", F.when(F.col("b") > 0, F.log(F.lit(2.0)) / F.col("b")))


def state_moves(states: DataFrame, key: str, period: str, state: str) -> DataFrame:
    """Row-normalised counts of moves between consecutive periods of a key (one row per key and period)."""
    w = Window.partitionBy(key).orderBy(period)
    pairs = states.withColumn("from_state", F.lag(state).over(w)).where("from_state is not null")
    counts = pairs.groupBy("from_state", F.col(state).alias("to_state")).agg(F.count(F.lit(1)).alias("moves"))
    leaving = counts.groupBy("from_state").agg(F.sum("moves").alias("_all"))
    return counts.join(leaving, "from_state").withColumn("share", F.col("moves") / F.col("_all")).drop("_all")


def moves_after(shares: DataFrame, steps: int) -> DataFrame:
    """Shares after several steps: the small matrix joined with itself."""
    one = shares.select("from_state", "to_state", "share")
    result = one
    for _ in range(steps - 1):
        nxt = one.select(F.col("from_state").alias("to_state"), F.col("to_state").alias("_to"), F.col("share").alias("_s"))
        result = result.join(nxt, "to_state").groupBy("from_state", F.col("_to").alias("to_state")).agg(
            F.sum(F.col("share") * F.col("_s")).alias("share"))
    return result


def below(value: str, limit: Column) -> Column:
    return F.coalesce((F.col(value) < limit).cast("int"), F.lit(0))
