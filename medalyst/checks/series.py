"""TS1-TS6: monthly series."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import half_up, money, money_avg, n, sql
from medalyst.checks.registry import query
from medalyst.operators import ordered, quantiles, relational, series

_SEG = """SELECT c_mktsegment AS segment, o_orderdate, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey"""
_MONTHLY = f"SELECT segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {money('o_totalprice')} AS total FROM seg GROUP BY ALL"
_GRID = """SELECT segment, month, COALESCE(total, 0.0) AS total FROM (SELECT segment, month FROM (SELECT DISTINCT segment FROM monthly) CROSS JOIN (SELECT CAST(UNNEST(generate_series((SELECT MIN(month)::TIMESTAMP FROM monthly),
    (SELECT MAX(month)::TIMESTAMP FROM monthly), INTERVAL 1 MONTH)) AS DATE) AS month)) LEFT JOIN monthly USING (segment, month)"""
_T = "SELECT *, ROW_NUMBER() OVER (PARTITION BY segment ORDER BY month) - 1 AS t FROM grid"
_BASE = dict(seg=_SEG, monthly=_MONTHLY, grid=_GRID, tt=_T)


def _series(t):
    placed = t.orders.join(t.customer, F.expr("o_custkey = c_custkey")).select(F.col("c_mktsegment").alias("segment"), "o_orderdate", "o_totalprice")
    return series.monthly_totals(placed, ["segment"], "o_orderdate", "o_totalprice", scale=2)


@query("ts1_monthly_grid", sql("SELECT * FROM grid", **_BASE))
def _(t):
    return _series(t)


@query("ts1_watch_by_age_and_platform", sql("""SELECT platform, age_group, month, COALESCE(total, 0.0) AS total FROM (SELECT platform, age_group, CAST(UNNEST(generate_series(MIN(month)::TIMESTAMP, MAX(month)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS month
    FROM m GROUP BY 1, 2) LEFT JOIN m USING (platform, age_group, month)""", "engagement", m=f"SELECT platform, age_group, CAST(date_trunc('month', subscription_date) AS DATE) AS month, {money('watch_mins')} AS total FROM engagement WHERE subscription_date IS NOT NULL GROUP BY ALL"))
def _(t):
    return series.monthly_totals(b.engagement(t), ["platform", "age_group"], "subscription_date", "watch_mins", shared_span=False, scale=2)


_TREND = "SELECT *, t % 3 AS phase, CASE WHEN COUNT(*) OVER w = 3 THEN AVG(total) OVER w END AS trend FROM tt WINDOW w AS (PARTITION BY segment ORDER BY t ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"
_PHASES = "SELECT segment, phase, AVG(total - trend) AS s FROM trended GROUP BY ALL"
_SEASONAL = "SELECT segment, phase, s - AVG(s) OVER (PARTITION BY segment) AS seasonal FROM phases"


@query("ts2_decomposition", sql(f"SELECT segment, month, total, CAST(t AS INTEGER) AS t, {half_up('trend', 4)} AS trend, {half_up('seasonal', 4)} AS seasonal, {half_up('total - trend - seasonal', 4)} AS residual FROM trended JOIN seasons USING (segment, phase)",
                                **_BASE, trended=_TREND, phases=_PHASES, seasons=_SEASONAL))
def _(t):
    return series.decomposed(_series(t), ["segment"]).withColumns({c: F.round(c, 4) for c in ("trend", "seasonal", "residual")})


_FIT = """SELECT segment, COUNT(*) AS k, AVG(total) AS mean, MAX(t) AS last_t, MAX(month) AS last_month, regr_slope(total, t) AS sl, regr_intercept(total, t) AS ic, SQRT(GREATEST(regr_syy(total, t) - regr_slope(total, t) * regr_sxy(total, t), 0) / (COUNT(*) - 2)) AS spread FROM tt GROUP BY 1"""
_AHEAD = f"""SELECT segment, CAST(step AS INTEGER) AS step, CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE) AS month, GREATEST(ic + sl * (last_t + step), 0) AS forecast, GREATEST(ic + sl * (last_t + step) - {series.Z95!r}::DOUBLE * spread, 0) AS low,
    GREATEST(ic + sl * (last_t + step) + {series.Z95!r}::DOUBLE * spread, 0) AS high, 'trend' AS model, CAST(k AS BIGINT) AS n_points FROM fit, (SELECT UNNEST([1, 2, 3]) AS step)"""


@query("ts3_forecast", sql(f"SELECT segment, step, month, {', '.join(half_up(c, 2) + f' AS {c}' for c in ('forecast', 'low', 'high'))}, model, n_points FROM ahead", **_BASE, fit=_FIT, ahead=_AHEAD))
def _(t):
    return series.forecast(_series(t), ["segment"]).withColumns({c: F.round(c, 2) for c in ("forecast", "low", "high")})


@query("ts4_backtest", sql(f"""SELECT segment, {half_up('AVG(ABS(total - g))', 2)} AS mae, {half_up('AVG(ABS(total - g) * 100 / NULLIF(ABS(total), 0))', 4)} AS mape, 'trend' AS model, CAST(MAX(k) AS BIGINT) AS n_points FROM (SELECT tt.segment, total, k, GREATEST(ic + sl * t, 0) AS g FROM tt JOIN (
    SELECT segment, COUNT(*) AS k, regr_slope(total, t) AS sl, regr_intercept(total, t) AS ic, MAX(t) AS lt FROM tt WHERE t <= (SELECT MAX(t) FROM tt) - 2 GROUP BY 1) f ON tt.segment = f.segment AND t > lt) GROUP BY 1""", **_BASE))
def _(t):
    return series.backtest(_series(t), ["segment"]).withColumns({"mae": F.round("mae", 2), "mape": F.round("mape", 4)})


# Holt's recursion month by month, for each pair of weights, over the months before the last two ('train') and over all ('whole')
_GRID_SQL = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE)" for a, b in series.GRID)
_CHOSEN = dict(
    spans="SELECT segment, MAX(t) AS last_t, MAX(month) AS last_month FROM tt GROUP BY 1",
    holt=f"""SELECT * FROM (WITH RECURSIVE h(segment, alpha, beta, t, base, slope, rss) AS (
      SELECT a.segment, g.alpha, g.beta, b.t, b.total, b.total - a.total, 0.0::DOUBLE FROM tt a JOIN tt b ON a.segment = b.segment AND a.t = 0 AND b.t = 1, (VALUES {_GRID_SQL}) g(alpha, beta)
      UNION ALL SELECT segment, alpha, beta, nt, nb, beta * (nb - base) + (1 - beta) * slope, rss + (y - base - slope) * (y - base - slope) FROM (
        SELECT h.*, tt.t AS nt, tt.total AS y, alpha * tt.total + (1 - alpha) * (base + slope) AS nb FROM h JOIN tt ON tt.segment = h.segment AND tt.t = h.t + 1))
      SELECT * FROM h)""",
    lines="""SELECT tt.segment, MAX(CASE WHEN tt.t <= last_t - 2 THEN tt.t END) AS at, regr_intercept(total, t) FILTER (WHERE t <= last_t - 2) AS ti, regr_slope(total, t) FILTER (WHERE t <= last_t - 2) AS ts, AVG(total) FILTER (WHERE t <= last_t - 2) AS tm,
      regr_intercept(total, t) AS wi, regr_slope(total, t) AS ws, AVG(total) AS wm, regr_syy(total, t) - regr_slope(total, t) * regr_sxy(total, t) AS wr, regr_syy(total, t) AS wv, COUNT(*) AS k FROM tt JOIN spans USING (segment) GROUP BY 1""",
    misses="""SELECT segment, 'mean' AS model, 0 AS rank, NULL::DOUBLE AS alpha, NULL::DOUBLE AS beta, AVG(ABS(total - GREATEST(tm, 0))) AS miss FROM tt JOIN spans USING (segment) JOIN lines USING (segment) WHERE t > last_t - 2 GROUP BY 1
      UNION ALL SELECT segment, 'trend', 1, NULL, NULL, AVG(ABS(total - GREATEST(ti + ts * t, 0))) FROM tt JOIN spans USING (segment) JOIN lines USING (segment) WHERE t > last_t - 2 GROUP BY 1
      UNION ALL SELECT tt.segment, 'holt', 2, alpha, beta, AVG(ABS(total - GREATEST(base + slope * (tt.t - holt.t), 0))) FROM tt JOIN spans USING (segment) JOIN holt ON holt.segment = tt.segment AND holt.t = last_t - 2 WHERE tt.t > last_t - 2 GROUP BY ALL""",
    picks="SELECT * FROM misses QUALIFY ROW_NUMBER() OVER (PARTITION BY segment ORDER BY miss, rank, alpha, beta) = 1",
    fits="""SELECT p.segment, p.model, p.alpha, p.beta, p.miss, last_month, k, CASE p.model WHEN 'holt' THEN base WHEN 'trend' THEN wi + ws * last_t ELSE wm END AS base, CASE p.model WHEN 'holt' THEN slope WHEN 'trend' THEN ws ELSE 0 END AS slope,
      SQRT(CASE p.model WHEN 'holt' THEN rss / (k - 2) WHEN 'trend' THEN GREATEST(wr, 0) / (k - 2) ELSE wv / (k - 1) END) AS spread FROM picks p JOIN spans USING (segment) JOIN lines USING (segment)
      LEFT JOIN holt h ON h.segment = p.segment AND h.t = last_t AND h.alpha = p.alpha AND h.beta = p.beta""")


@query("ts3_chosen_forecast", sql(f"""SELECT segment, CAST(step AS INTEGER) AS step, CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE) AS month, model, alpha, beta, CAST(k AS BIGINT) AS n_points, {half_up('miss', 2)} AS holdout_mae,
    {half_up('GREATEST(base + slope * step, 0)', 2)} AS forecast, {half_up(f'GREATEST(base + slope * step - {series.Z95!r}::DOUBLE * spread, 0)', 2)} AS low, {half_up(f'GREATEST(base + slope * step + {series.Z95!r}::DOUBLE * spread, 0)', 2)} AS high
    FROM fits, (SELECT UNNEST([1, 2, 3]) AS step)""", **_BASE, **_CHOSEN))
def _(t):
    return series.chosen_forecast(_series(t), ["segment"]).withColumns({c: F.round(c, 2) for c in ("forecast", "low", "high", "holdout_mae")})


_GROWTH = f"""SELECT segment, h AS history_mean, fm AS forecast_mean, nm AS next_month, (fm - h) * 100 / h AS growth_pct FROM (SELECT segment, {money_avg('total')} AS h FROM grid GROUP BY 1) JOIN (
    SELECT segment, AVG(forecast) AS fm, MAX(CASE WHEN step = 1 THEN forecast END) AS nm FROM ahead GROUP BY 1) USING (segment)"""


@query("ts5_growth", sql(f"SELECT segment, {', '.join(half_up(c, 2) + f' AS {c}' for c in ('history_mean', 'forecast_mean', 'next_month'))}, {half_up('growth_pct', 4)} AS growth_pct FROM g", **_BASE, fit=_FIT, ahead=_AHEAD, g=_GROWTH))
def _(t):
    s = _series(t)
    out = series.growth_against_history(s, series.forecast(s, ["segment"]), ["segment"], scale=2)
    return out.withColumns({"history_mean": F.round("history_mean", 2), "forecast_mean": F.round("forecast_mean", 2), "next_month": F.round("next_month", 2), "growth_pct": F.round("growth_pct", 4)})


@query("ts5_fastest_growing", sql(f"SELECT arg_max(segment, (growth_pct, segment)) AS top_group, {half_up('MAX(growth_pct)', 4)} AS growth_pct, {half_up('SUM(next_month)', 2)} AS next_month_total FROM g", **_BASE, fit=_FIT, ahead=_AHEAD, g=_GROWTH))
def _(t):
    s = _series(t)
    out = series.fastest_growing(series.growth_against_history(s, series.forecast(s, ["segment"]), ["segment"], scale=2), "segment")
    return out.withColumns({"growth_pct": F.round("growth_pct", 4), "next_month_total": F.round("next_month_total", 2)})


@query("ts6_lag_features", sql("""SELECT o_orderkey, low_watch, LAG(low_watch, 1, 0) OVER w AS low_lag1, LAG(low_watch, 2, 0) OVER w AS low_lag2, tenure_days FROM (
    SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice < med AS INTEGER) AS low_watch, CAST(CAST(o_orderdate AS DATE) - first_day AS INTEGER) AS tenure_days FROM orders JOIN (
    SELECT date_trunc('month', o_orderdate) AS m, median(o_totalprice) AS med FROM orders GROUP BY 1) ON date_trunc('month', o_orderdate) = m JOIN (
    SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_day FROM orders GROUP BY 1) USING (o_custkey)) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""))
def _(t):
    from medalyst.functions.columns import month_start
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", month_start("o_orderdate").alias("month"))
    medians = quantiles.exact_quantiles(o, "o_totalprice", {"med": 0.5}, ["month"])
    firsts = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_day"))
    flagged = relational.null_safe_join(o, medians, ["month"]).join(firsts, "o_custkey").select(
        "o_orderkey", "o_custkey", "o_orderdate", series.below("o_totalprice", F.col("med")).alias("low_watch"), F.datediff("o_orderdate", "first_day").alias("tenure_days"))
    out = ordered.lagged(flagged, {"low_lag1": ("low_watch", 1), "low_lag2": ("low_watch", 2)}, ["o_orderdate", "o_orderkey"], ["o_custkey"], 0)
    return out.select("o_orderkey", "low_watch", "low_lag1", "low_lag2", "tenure_days")
