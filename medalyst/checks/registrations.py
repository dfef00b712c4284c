"""Vehicle registrations."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import count_if, half_even, half_up, money_avg, n, sql
from medalyst.checks.registry import query
from medalyst.operators.relational import frequency
from medalyst.operators.stats import chi_square_uniform
from medalyst.plans import registrations as p

for _label, _cols in (("county", ["county"]), ("make", ["make"]), ("model", ["make", "model"])):
    @query(f"e01_top_{_label}", sql(f"SELECT {', '.join(_cols)}, {n()} AS n FROM vehicles GROUP BY ALL ORDER BY n DESC, {', '.join(_cols)} LIMIT 10", "vehicles"))
    def _(t, cols=_cols):
        return p.top_counts(b.vehicles(t), cols, 10)


@query("e01_mean_per_city", sql(f"SELECT county, {half_up('AVG(n)', 4)} AS avg_per_group, {n()} AS groups FROM (SELECT county, city, COUNT(*) AS n FROM vehicles GROUP BY ALL) GROUP BY 1", "vehicles"))
def _(t):
    return p.mean_count_per(b.vehicles(t), "county", "city")


for _place in ("county", "city"):
    @query(f"e02_dominant_make_by_{_place}", sql(f"""SELECT {_place}, make, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {_place} ORDER BY n DESC, make) AS r FROM (
        SELECT {_place}, make, {n()} AS n FROM vehicles GROUP BY ALL)) WHERE r = 1""", "vehicles"))
    def _(t, place=_place):
        return p.dominant(b.vehicles(t), place, "make")


@query("e03_model_by_year", sql(f"SELECT model_year, model, {n()} AS n FROM vehicles GROUP BY ALL", "vehicles"))
def _(t):
    return frequency(b.vehicles(t), ["model_year", "model"])


@query("e03_registrations_by_year", sql(f"SELECT model_year, {n()} AS n FROM vehicles GROUP BY ALL", "vehicles"))
def _(t):
    return frequency(b.vehicles(t), ["model_year"])


@query("e04_longest_range", sql(f"""SELECT model, make, model_year, electric_range, registered FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY electric_range DESC, model_year DESC, make) AS r FROM (
    SELECT model, make, model_year, electric_range, {n()} AS registered FROM vehicles GROUP BY ALL)) WHERE r = 1""", "vehicles"))
def _(t):
    return p.longest_range(b.vehicles(t))


for _name, _col in (("e05_type_mix", "ev_type"), ("e11_eligibility_mix", "cafv")):
    @query(_name, sql(f"SELECT {_col}, {n()} AS n, {half_even('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()')} AS pct FROM vehicles GROUP BY 1", "vehicles"))
    def _(t, col=_col):
        return p.mix(b.vehicles(t), col)


@query("e06_tract_counts", sql(f"SELECT census_tract, {n()} AS n FROM vehicles GROUP BY 1", "vehicles"))
def _(t):
    return frequency(b.vehicles(t), ["census_tract"])


@query("e06_tract_histogram", sql(f"""SELECT CAST(LEAST(FLOOR((census_tract - lo) * 30 / CAST(hi - lo AS DOUBLE)), 29) AS INTEGER) AS bin, {n()} AS n FROM vehicles,
    (SELECT MIN(census_tract) AS lo, MAX(census_tract) AS hi FROM vehicles) GROUP BY 1""", "vehicles"))
def _(t):
    return p.histogram(b.vehicles(t), "census_tract", 30)


_UTILITY = f"""SELECT upper(p[1]) || lower(p[2:]) || ', ' || q AS utility, {n()} AS n FROM (
    SELECT split_part(electric_utility, '||', 1) AS p, split_part(electric_utility, '||', 2) AS q FROM vehicles) GROUP BY 1"""


@query("e07_utility_counts", sql(_UTILITY, "vehicles"))
def _(t):
    return p.utility_counts(b.vehicles(t), "electric_utility")


@query("e07_utility_uniformity", sql(f"SELECT {half_up('SUM(n * n) * COUNT(*) / SUM(n)::DOUBLE - SUM(n)', 6)} AS chi2, {n()} - 1 AS dof FROM ({_UTILITY})", "vehicles"))
def _(t):
    return chi_square_uniform(p.utility_counts(b.vehicles(t), "electric_utility")).select(F.round("chi2", 6).alias("chi2"), "dof")


@query("e08_mean_range_top", sql(f"SELECT county, make, {half_up(money_avg('electric_range'))} AS mean_range FROM vehicles GROUP BY ALL ORDER BY mean_range DESC, county, make LIMIT 20", "vehicles"))
def _(t):
    return p.mean_by(b.vehicles(t), ["county", "make"], "electric_range", "mean_range", k=20)


@query("e08_mean_range_by_county", sql(f"SELECT county, {half_up(money_avg('electric_range'))} AS mean_range FROM vehicles GROUP BY ALL", "vehicles"))
def _(t):
    return p.mean_by(b.vehicles(t), ["county"], "electric_range", "mean_range")


@query("e09_above_average_places", sql(f"""SELECT city, main_count, other_count FROM c WHERE main_count > (SELECT AVG(main_count) FROM c WHERE main_count > 0) AND other_count > 0""", "vehicles",
                                       c=f"""SELECT city, {count_if("ev_type = 'BEV'")} AS main_count, {count_if("ev_type = 'PHEV'")} AS other_count FROM vehicles GROUP BY 1"""))
def _(t):
    return p.above_average_places(b.vehicles(t), "city", "ev_type", "BEV", "PHEV")


for _label, _cols in (("make_model", ["make", "model"]), ("county", ["county"]), ("tract", ["census_tract"])):
    @query(f"e10_mean_price_by_{_label}", sql(f"SELECT * FROM (SELECT {', '.join(_cols)}, {half_up(money_avg('base_msrp'))} AS mean_price FROM vehicles GROUP BY ALL) WHERE mean_price > 0", "vehicles"))
    def _(t, cols=_cols):
        return p.mean_by(b.vehicles(t), cols, "base_msrp", "mean_price", positive=True)


@query("e11_eligible_share", sql(f"""SELECT * FROM (SELECT county, {half_even(count_if("cafv = 'Eligible'") + ' * 100.0::DOUBLE / COUNT(*)')} AS eligible_pct FROM vehicles GROUP BY 1) WHERE eligible_pct > 0""", "vehicles"))
def _(t):
    return p.eligible_share(b.vehicles(t), "county", "cafv", "Eligible")


@query("e11_top_eligible_models", sql(f"SELECT model, {n()} AS n FROM vehicles WHERE cafv = 'Eligible' GROUP BY 1 ORDER BY n DESC, model LIMIT 10", "vehicles"))
def _(t):
    return p.top_counts(b.vehicles(t).where("cafv = 'Eligible'"), ["model"], 10)


@query("e12_price_and_count", sql(f"SELECT county, {half_up(money_avg('base_msrp'))} AS avg_price, {n()} AS vehicles FROM vehicles GROUP BY 1", "vehicles"))
def _(t):
    return p.price_and_count(b.vehicles(t), "county", "base_msrp")


@query("e13_price_spread", sql(f"""SELECT cafv, {n()} AS n, MIN(base_msrp) AS low, {', '.join(half_up(f'quantile_cont(base_msrp, {q})', 4) + f' AS {a}' for q, a in ((0.25, 'q1'), (0.5, 'median'), (0.75, 'q3')))},
    MAX(base_msrp) AS high FROM vehicles GROUP BY 1""", "vehicles"))
def _(t):
    return p.box_stats(b.vehicles(t), "cafv", "base_msrp")
