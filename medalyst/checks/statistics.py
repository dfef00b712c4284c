"""ST01-ST10: statistical tests. p-values have no SQL counterpart and get their own rows-only queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from medalyst.checks import bindings as b
from medalyst.checks.oracle import count_if, half_up, n, sql
from medalyst.checks.registry import query
from medalyst.checks.subscribers import _SWITCH
from medalyst.operators import logistic, stats
from medalyst.operators.relational import frequency
from medalyst.operators.series import below

_NUMERIC = ["watch_mins", "plan_price", "age_code", "inactivity_flag"]
_AGE = {"18-24": 0, "25-34": 1, "35-44": 2, "45+": 3}
_AGE_SQL = "CASE age_group WHEN '18-24' THEN 0 WHEN '25-34' THEN 1 WHEN '35-44' THEN 2 ELSE 3 END"


def rounded(df, **digits):
    return df.withColumns({c: F.round(c, k) for c, k in digits.items()})


def _coded(t):
    from medalyst.functions.columns import lookup
    return b.engagement(t).withColumn("age_code", lookup("age_group", _AGE))


_PAIRS = " UNION ALL ".join(f"SELECT '{a}' AS a, '{c}' AS b, {half_up(f'corr({a}, {c})', 9)} AS r, {n()} AS n FROM coded"
                            for i, a in enumerate(_NUMERIC) for c in _NUMERIC[i + 1:])
_CODED = f"SELECT *, {_AGE_SQL} AS age_code FROM engagement"


@query("st01_pearson_pairs", sql(_PAIRS, "engagement", coded=_CODED))
def _(t):
    return rounded(stats.pearson_pairs(_coded(t), _NUMERIC).select("a", "b", "r", "n"), r=9)


@query("st01_pearson_p_values")
def _(t):
    return stats.pearson_pairs(_coded(t), _NUMERIC)


@query("st01_strongest_pairs_of_downgrades", sql(f"SELECT a, b, r FROM ({_PAIRS}) WHERE r IS NOT NULL ORDER BY ABS(r) DESC, a, b LIMIT 3", "engagement",
                                                 coded=f"""SELECT *, {_AGE_SQL} AS age_code FROM engagement WHERE CASE new_subscription_plan WHEN 'Free' THEN 0 WHEN 'Basic' THEN 1 WHEN 'Premium' THEN 2 ELSE 3 END
                                                 < CASE subscription_plan WHEN 'Free' THEN 0 WHEN 'Basic' THEN 1 WHEN 'Premium' THEN 2 ELSE 3 END"""))
def _(t):
    from medalyst.plans.subscribers import with_plan_move
    down = with_plan_move(_coded(t)).where("plan_move = 'Downgrade'")
    pairs = stats.pearson_pairs(down, _NUMERIC)
    return rounded(stats.strongest_pairs(pairs.withColumn("r", F.round("r", 9)), 3).select("a", "b", "r"), r=9)


@query("st02_chi_square_uniform", f"SELECT {half_up('SUM(n * n) * COUNT(*) / SUM(n)::DOUBLE - SUM(n)', 6)} AS chi2, {n()} - 1 AS dof FROM (SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1)")
def _(t):
    return rounded(stats.chi_square_uniform(frequency(t.lineitem, ["l_suppkey"])).drop("p_value"), chi2=6)


@query("st02_chi_square_uniform_p_value")
def _(t):
    return stats.chi_square_uniform(frequency(t.lineitem, ["l_suppkey"]))


@query("st03_chi_square_table", f"""SELECT {half_up('MAX(tot) * (SUM(o * o / (ra * cb)::DOUBLE) - 1)', 6)} AS chi2, (COUNT(DISTINCT a) - 1) * (COUNT(DISTINCT b) - 1) AS dof FROM (
    SELECT a, b, o, SUM(o) OVER (PARTITION BY a) AS ra, SUM(o) OVER (PARTITION BY b) AS cb, SUM(o) OVER () AS tot FROM (SELECT o_orderpriority AS a, o_orderstatus AS b, COUNT(*) AS o FROM orders GROUP BY ALL))""")
def _(t):
    return rounded(stats.chi_square_table(t.orders, "o_orderpriority", "o_orderstatus").drop("p_value"), chi2=6)


_GAP = "ABS(n11 - (n11 + n10) * (n11 + n01) / nn)"


@query("st03_chi_square_2x2", f"""SELECT l_linestatus, n11, n10, n01, n00, {half_up(f'pow({_GAP} - LEAST(0.5, {_GAP}), 2) * nn * nn * nn / ((n11 + n10) * (n01 + n00) * (n11 + n01) * (n10 + n00))', 6)} AS chi2 FROM (
    SELECT l_linestatus, CAST(COUNT(*) FILTER (WHERE r AND q) AS DOUBLE) AS n11, CAST(COUNT(*) FILTER (WHERE r AND NOT q) AS DOUBLE) AS n10, CAST(COUNT(*) FILTER (WHERE NOT r AND q) AS DOUBLE) AS n01,
    CAST(COUNT(*) FILTER (WHERE NOT r AND NOT q) AS DOUBLE) AS n00, CAST(COUNT(*) AS DOUBLE) AS nn FROM (SELECT l_linestatus, l_returnflag = 'R' AS r, l_quantity > 25 AS q FROM lineitem) GROUP BY 1)""")
def _(t):
    out = stats.chi_square_2x2(t.lineitem, F.col("l_returnflag") == "R", F.col("l_quantity") > 25, by=["l_linestatus"])
    return rounded(out.drop("p_value"), chi2=6)


_ARMS = f"""SELECT event_type, {count_if('NOT arm')} AS n_control, {count_if('arm')} AS n_treatment, {count_if('NOT arm AND won')} AS x_control, {count_if('arm AND won')} AS x_treatment FROM (
    SELECT event_type, substr(md5('exp1:' || CAST(user_id AS VARCHAR)), 32, 1) IN ('1', '3', '5', '7', '9', 'b', 'd', 'f') AS arm, value > 40 AS won FROM events) GROUP BY 1"""


def _wilson(g: str, sign: str) -> str:
    z2, x, m = stats.Z95 ** 2, f"x_{g}::DOUBLE", f"n_{g}"
    p = f"({x} / {m})"
    return half_up(f"(({p} + {z2!r}::DOUBLE / (2 * {m})) {sign} {stats.Z95!r}::DOUBLE * sqrt({p} * (1 - {p}) / {m} + {z2!r}::DOUBLE / (4.0 * {m} * {m}))) / (1 + {z2!r}::DOUBLE / {m})", 9)


_TWO = f"""SELECT *, {half_up('x_treatment / n_treatment::DOUBLE', 9)} AS rate_treatment, {half_up('x_control / n_control::DOUBLE', 9)} AS rate_control,
    {half_up('(x_treatment / n_treatment::DOUBLE - x_control / n_control::DOUBLE) * 100 / (x_control / n_control::DOUBLE)', 6)} AS lift_pct,
    {half_up('(x_treatment / n_treatment::DOUBLE - x_control / n_control::DOUBLE) / sqrt((x_treatment + x_control) / (n_treatment + n_control)::DOUBLE * (1 - (x_treatment + x_control) / (n_treatment + n_control)::DOUBLE) * (1 / n_treatment::DOUBLE + 1 / n_control::DOUBLE))', 6)} AS z_stat,
    n_treatment >= 30 AND n_control >= 30 AS enough, {', '.join(f'{_wilson(g, s)} AS {name}_{g}' for g in ('treatment', 'control') for name, s in (('low', '-'), ('high', '+')))} FROM a"""


@query("st04_two_proportions", sql(_TWO, a=_ARMS))
def _(t):
    out = stats.two_proportions(t.events, stats.ab_arm("user_id", "exp1"), F.col("value") > 40, by=["event_type"]).drop("p_value")
    return rounded(out, rate_treatment=9, rate_control=9, lift_pct=6, z_stat=6, low_treatment=9, high_treatment=9, low_control=9, high_control=9)


@query("st05_paired_t", sql(f"""SELECT city_tier, {n()} AS n, {half_up('AVG(post - pre)', 6)} AS mean_diff, {half_up('STDDEV_SAMP(post - pre)', 6)} AS std_diff, {half_up('AVG(post - pre) * sqrt(COUNT(*)) / STDDEV_SAMP(post - pre)', 6)} AS t_stat FROM s GROUP BY 1""", "engagement", s=_SWITCH))
def _(t):
    from medalyst.plans.subscribers import laptop_switchers
    return rounded(stats.paired_t(laptop_switchers(b.engagement(t)), "pre", "post", ["city_tier"]).drop("p_value"), mean_diff=6, std_diff=6, t_stat=6)


@query("st05_welch_t", f"""SELECT {half_up('(m1 - m2) / sqrt(v1 / n1 + v2 / n2)', 6)} AS t_stat, {half_up('pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1))', 4)} AS dof FROM (
    SELECT AVG(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS m1, AVG(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END) AS m2, VAR_SAMP(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS v1,
    VAR_SAMP(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END) AS v2, CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS n1, CAST(COUNT(*) FILTER (WHERE l_returnflag <> 'R') AS DOUBLE) AS n2 FROM lineitem)""")
def _(t):
    x, first = F.col("l_extendedprice"), F.col("l_returnflag") == "R"
    sides = {"1": F.when(first, x), "2": F.when(~first, x)}
    cells = t.lineitem.agg(*[f(c).alias(f"{name}{i}") for i, c in sides.items() for name, f in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp))])
    return rounded(stats.welch_t(cells).select("t_stat", "dof"), t_stat=6, dof=4)


@query("st06_ks_two_sample", f"""SELECT {half_up('MAX(ABS(f1 - f2))', 9)} AS d_stat, {n()} * 0 + MAX(n1) AS n1, MAX(n2) AS n2 FROM (SELECT SUM(c1) OVER w / n1::DOUBLE AS f1, SUM(c2) OVER w / n2::DOUBLE AS f2, n1, n2 FROM (
    SELECT value, COUNT(*) FILTER (WHERE event_type = 'view') AS c1, COUNT(*) FILTER (WHERE event_type <> 'view') AS c2 FROM events GROUP BY 1),
    (SELECT {count_if("event_type = 'view'")} AS n1, {count_if("event_type <> 'view'")} AS n2 FROM events) WINDOW w AS (ORDER BY value))""")
def _(t):
    return rounded(stats.ks_two_sample(t.events, "value", F.col("event_type") == "view").drop("p_value"), d_stat=9)


@query("st06_ks_p_value")
def _(t):
    return stats.ks_two_sample(t.events, "value", F.col("event_type") == "view")


@query("st07_cell_variances", sql(f"SELECT age_group, city_tier, {n()} AS n, {half_up('AVG(watch_mins)', 4)} AS mean, {half_up('VAR_SAMP(watch_mins)', 2)} AS variance FROM engagement GROUP BY ALL", "engagement"))
def _(t):
    return rounded(stats.cell_variances(b.engagement(t), ["age_group", "city_tier"], "watch_mins"), mean=4, variance=2)


@query("st07_widest_cell", sql(f"SELECT age_group, city_tier, {n()} AS n, {half_up('AVG(watch_mins)', 4)} AS mean, {half_up('VAR_SAMP(watch_mins)', 2)} AS variance FROM engagement GROUP BY age_group, city_tier ORDER BY VAR_SAMP(watch_mins) DESC LIMIT 1", "engagement"))
def _(t):
    return rounded(stats.widest_cell(b.engagement(t), ["age_group", "city_tier"], "watch_mins"), mean=4, variance=2)


# the additive fit by alternating means over the levels, until nothing moves
_ADDITIVE = sql("""SELECT 'age_group' AS term, r_both - r_b AS sum_sq, CAST(ka - 1 AS DOUBLE) AS dof FROM fit UNION ALL SELECT 'city_tier', r_both - r_a, kb - 1 FROM fit
    UNION ALL SELECT 'age_group:city_tier', r_cells - r_both, k - ka - kb + 1 FROM fit UNION ALL SELECT 'residual', within, n - k FROM fit""", "engagement",
    known="SELECT age_group AS a, city_tier AS b, watch_mins - AVG(watch_mins) OVER () AS x FROM engagement WHERE age_group IS NOT NULL AND city_tier IS NOT NULL AND watch_mins IS NOT NULL",
    cells="SELECT a, b, CAST(COUNT(*) AS DOUBLE) AS n, SUM(x) AS s, VAR_POP(x) * COUNT(*) AS w FROM known GROUP BY ALL",
    la="SELECT list(a ORDER BY a) AS names, list(n ORDER BY a) AS n, list(s ORDER BY a) AS s FROM (SELECT a, SUM(n) AS n, SUM(s) AS s FROM cells GROUP BY 1)",
    lb="SELECT list(b ORDER BY b) AS names, list(n ORDER BY b) AS n, list(s ORDER BY b) AS s FROM (SELECT b, SUM(n) AS n, SUM(s) AS s FROM cells GROUP BY 1)",
    grid="SELECT list(r ORDER BY a) AS m FROM (SELECT a, list(n ORDER BY b) AS r FROM (SELECT la.a, lb.b, COALESCE(cells.n, 0) AS n FROM (SELECT DISTINCT a FROM cells) la CROSS JOIN (SELECT DISTINCT b FROM cells) lb LEFT JOIN cells USING (a, b)) GROUP BY 1)",
    effects="""SELECT al, be FROM (WITH RECURSIVE step(i, al, be) AS (
      SELECT 0, list_transform(la.n, lambda v: 0.0::DOUBLE), list_transform(lb.n, lambda v: 0.0::DOUBLE) FROM la, lb
      UNION ALL SELECT i + 1, na, list_transform(range(1, len(be) + 1), lambda j: (lb.s[j] - list_dot_product(na, list_transform(m, lambda r: r[j]))) / lb.n[j]) FROM (
        SELECT i, be, m, list_transform(range(1, len(al) + 1), lambda k: (la.s[k] - list_dot_product(be, m[k])) / la.n[k]) AS na FROM step, la, grid WHERE i < 200), lb)
      SELECT al, be FROM step WHERE i = 200)""",
    fit="""SELECT list_dot_product(al, la.s) + list_dot_product(be, lb.s) AS r_both, (SELECT SUM(s * s / n) FROM cells) AS r_cells, (SELECT SUM(w) FROM cells) AS within, (SELECT SUM(n) FROM cells) AS n, (SELECT COUNT(*) FROM cells) AS k,
      list_sum(list_transform(range(1, len(al) + 1), lambda k: la.s[k] * la.s[k] / la.n[k])) AS r_a, list_sum(list_transform(range(1, len(be) + 1), lambda k: lb.s[k] * lb.s[k] / lb.n[k])) AS r_b, len(al) AS ka, len(be) AS kb FROM effects, la, lb""")


@query("st07_two_way_anova", f"SELECT term, {half_up('sum_sq', 3)} AS sum_sq, dof FROM ({_ADDITIVE})")
def _(t):
    return rounded(stats.two_way_anova(b.engagement(t), "age_group", "city_tier", "watch_mins").select("term", "sum_sq", "dof"), sum_sq=3)


@query("st07_anova_p_values")
def _(t):
    return stats.two_way_anova(b.engagement(t), "age_group", "city_tier", "watch_mins")


_LOG_PRICE = "ln(l_extendedprice) + 1"
_LOG_QTY = "ln(l_quantity) + 1"


@query("st08_elasticities", f"""SELECT 'group' AS part, {half_up(f'regr_slope({_LOG_PRICE}, {_LOG_QTY})', 6)} AS elasticity, {half_up(f'regr_slope({_LOG_PRICE}, {_LOG_QTY}) * 10', 5)} AS lift_effect_pct FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT 'others', {half_up(f'regr_slope({_LOG_PRICE}, {_LOG_QTY})', 6)}, {half_up(f'regr_slope({_LOG_PRICE}, {_LOG_QTY}) * 10', 5)} FROM lineitem WHERE l_returnflag <> 'R'""")
def _(t):
    out = stats.elasticities(t.lineitem, F.log("l_extendedprice") + 1, F.log("l_quantity") + 1, F.col("l_returnflag") == "R")
    return rounded(out.select("part", "elasticity", "lift_effect_pct"), elasticity=6, lift_effect_pct=5)


@query("st08_ols", f"""SELECT 'const' AS term, {half_up('regr_intercept(l_extendedprice, l_quantity)', 4)} AS coef FROM lineitem UNION ALL SELECT 'quantity', {half_up('regr_slope(l_extendedprice, l_quantity)', 4)} FROM lineitem""")
def _(t):
    return rounded(stats.ols(t.lineitem, F.col("l_extendedprice"), {"quantity": F.col("l_quantity")}).select("term", "coef"), coef=4)


@query("st08_ols_intervals")
def _(t):
    return stats.ols(t.lineitem, F.log("l_extendedprice"), {"quantity": F.col("l_quantity"), "discount": F.col("l_discount"), "tax": F.col("l_tax")})


@query("st09_odds_ratios")
def _(t):
    from medalyst.plans.subscribers import with_downgrade_flag
    coded = with_downgrade_flag(_coded(t))
    mean = coded.agg(F.avg("watch_mins")).scalar()
    return logistic.odds_ratios(coded.withColumn("low_watch", below("watch_mins", mean)), "downgrade_flag", ["low_watch", "inactivity_flag", "age_code"], "platform")


# with one flag as the only feature the fit has a closed form: the odds of the two-by-two table
_SIDES = ", ".join(f"CAST(COUNT(*) FILTER (WHERE y = {y} AND x = {x}) AS DOUBLE) AS n{y}{x}" for y in (0, 1) for x in (0, 1))
_ODDS = {"const": ("n10 / n00", "1 / n10 + 1 / n00"), "large": ("n11 * n00 / (n10 * n01)", "1 / n11 + 1 / n10 + 1 / n01 + 1 / n00")}


@query("st09_odds_of_a_flag", "WITH f AS (SELECT CAST(l_suppkey AS VARCHAR) AS g, CAST(l_returnflag = 'R' AS INTEGER) AS y, CAST(l_quantity > 25 AS INTEGER) AS x FROM lineitem), "
       f"c AS (SELECT g, {_SIDES} FROM f GROUP BY 1 UNION ALL SELECT 'Overall', {_SIDES} FROM f) "
       + " UNION ALL ".join(f"SELECT g AS part, '{term}' AS term, {half_up(odds, 7)} AS odds_ratio, {half_up(f'exp(ln({odds}) - {stats.Z95!r}::DOUBLE * sqrt({var}))', 7)} AS low, {half_up(f'exp(ln({odds}) + {stats.Z95!r}::DOUBLE * sqrt({var}))', 7)} AS high, CAST(n00 + n01 + n10 + n11 AS BIGINT) AS n_rows, TRUE AS converged FROM c"
                            for term, (odds, var) in _ODDS.items()))
def _(t):
    flagged = t.lineitem.select("l_suppkey", (F.col("l_returnflag") == "R").cast("int").alias("returned"), (F.col("l_quantity") > 25).cast("int").alias("large"))
    return rounded(logistic.odds_ratios(flagged, "returned", ["large"], "l_suppkey").drop("p_value"), odds_ratio=7, low=7, high=7)


@query("st10_hash_assignment", f"""SELECT CASE WHEN substr(md5('exp1:' || CAST(c_custkey AS VARCHAR)), 32, 1) IN ('1', '3', '5', '7', '9', 'b', 'd', 'f') THEN 'treatment' ELSE 'control' END AS arm, {n()} AS users FROM customer GROUP BY 1""")
def _(t):
    arm = F.when(stats.ab_arm("c_custkey", "exp1"), "treatment").otherwise("control")
    return t.customer.groupBy(arm.alias("arm")).agg(F.count(F.lit(1)).alias("users"))
