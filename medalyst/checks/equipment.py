"""Equipment effectiveness."""

from __future__ import annotations

from medalyst.checks import bindings as b
from medalyst.checks.oracle import half_even, half_up, money, money_avg, sql
from medalyst.checks.registry import query
from medalyst.plans import equipment as p

_A = f"{money('run_min', 4)} / {money('planned_min', 4)}"
_P = f"{money('ideal_min * units', 6)} / {money('run_min', 4)}"
_Q = f"({money('units')} - {money('rejects')}) / {money('units')}"
_OEE = f"""SELECT machine, {half_up(_A, 4)} AS availability, {half_up(_P, 4)} AS performance, {half_up(_Q, 4)} AS quality,
    {half_up(f'1.0::DOUBLE - ({_Q})', 4)} AS rejection_rate, {half_up(f'({_A}) * ({_P}) * ({_Q})', 4)} AS oee FROM runs GROUP BY 1"""

for _name, _cols in (("o01_availability", "availability"), ("o02_performance", "performance"), ("o03_quality", "quality, rejection_rate"), ("o04_oee", "oee")):
    @query(_name, sql(f"SELECT machine, {_cols} FROM e", "runs", e=_OEE))
    def _(t, cols=_cols):
        return p.effectiveness(b.machine_runs(t)).select("machine", *cols.split(", "))


@query("o04_underperformers", sql("SELECT machine, oee FROM e WHERE oee < (SELECT AVG(oee) FROM e)", "runs", e=_OEE))
def _(t):
    return p.underperformers(p.effectiveness(b.machine_runs(t)))


_PARETO = f"""SELECT {{by}}, m AS downtime_min, {half_up('cum / whole * 100')} AS cumulative_pct, (cum - m) / whole * 100 < 70 AS top_contributor FROM (
    SELECT {{by}}, m, CAST(SUM(CAST(m AS DECIMAL(18,2))) OVER (ORDER BY m DESC, {{by}}) AS DOUBLE) AS cum, CAST(SUM(CAST(m AS DECIMAL(18,2))) OVER () AS DOUBLE) AS whole
    FROM (SELECT {{by}}, {money('minutes')} AS m FROM stops GROUP BY 1))"""

for _by in ("category", "machine"):
    @query(f"o05_downtime_pareto_by_{_by}", sql(_PARETO.format(by=_by), "stops"))
    def _(t, by=_by):
        return p.downtime_pareto(b.stops(t), by, "minutes")


@query("o05_downtime_mix", sql(f"SELECT category, m AS downtime_min, {half_even('m * 100.0::DOUBLE / SUM(m) OVER ()')} AS pct FROM (SELECT category, {money('minutes')} AS m FROM stops GROUP BY 1)", "stops"))
def _(t):
    return p.downtime_mix(b.stops(t), "category", "minutes")


@query("o06_cycle_variability", sql(f"""SELECT shift, {half_up('AVG(cycle_min)', 4)} AS mean_cycle, {half_up('STDDEV_SAMP(cycle_min)', 4)} AS std_cycle,
    {half_up('STDDEV_SAMP(cycle_min) / AVG(cycle_min)', 4)} AS cv FROM runs GROUP BY 1""", "runs"))
def _(t):
    return p.cycle_variability(b.machine_runs(t), "shift", "cycle_min")


@query("o07_bottleneck", sql(f"SELECT machine, {half_up(money_avg('cycle_min', 6), 6)} AS mean_cycle FROM runs GROUP BY 1 ORDER BY mean_cycle DESC, machine LIMIT 1", "runs"))
def _(t):
    return p.bottleneck(b.machine_runs(t), "machine", "cycle_min")
