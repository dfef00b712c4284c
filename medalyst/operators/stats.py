"""Statistical tests: sufficient statistics in one Spark aggregation, closed forms on the result row."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.functions.distributions import chi2_p, f_tail, ks_p, normal_p, t_p, t_two_sided
from medalyst.operators.ordered import running_total
from medalyst.session import durable

Z95 = 1.959963984540054      # two-sided 95 percent normal quantile


def pearson_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation of every pair of columns with its p-value, all pairs in one pass."""
    pairs = list(combinations(cols, 2))
    both = lambda a, b: F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull())
    one = df.agg(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r"),
                            both(a, b).alias("n")).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    long = one.select(F.explode(F.array(*[f"p{i}" for i in range(len(pairs))])).alias("p")).select("p.*")
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2.0, F.lit(1.0) - F.col("r") * F.col("r")))
    return long.withColumn("t_stat", t).withColumn("p_value", t_p(F.col("t_stat"), (F.col("n") - 2).cast("double")))


def strongest_pairs(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.where("r is not null").orderBy(F.desc(F.abs("r")), "a", "b").limit(k)


def chi_square_uniform(counts: DataFrame, n: str = "n") -> DataFrame:
    """Goodness of fit of category counts to equal shares."""
    x = F.col(n).cast("double")
    s = counts.agg(F.sum(x).alias("total"), F.sum(x * x).alias("squares"), F.count(x).alias("k"))
    stat = F.col("squares") * F.col("k") / F.col("total") - F.col("total")
    return s.select(stat.alias("chi2"), (F.col("k") - 1).alias("dof")).withColumn(
        "p_value", chi2_p(F.col("chi2"), F.col("dof").cast("double")))


def chi_square_table(df: DataFrame, a: str, b: str) -> DataFrame:
    """Independence of two categorical columns, no continuity correction."""
    cells = df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("o"))
    rows = cells.groupBy(a).agg(F.sum("o").alias("ra"))
    cols = cells.groupBy(b).agg(F.sum("o").alias("cb"))
    s = cells.join(rows, a).join(cols, b).agg(
        F.sum(F.col("o") * F.col("o") / (F.col("ra") * F.col("cb"))).alias("q"), F.sum("o").alias("n"),
        F.countDistinct(a).alias("na"), F.countDistinct(b).alias("nb"))
    return s.select((F.col("n") * (F.col("q") - 1)).alias("chi2"),
                    ((F.col("na") - 1) * (F.col("nb") - 1)).alias("dof")).withColumn(
        "p_value", chi2_p(F.col("chi2"), F.col("dof").cast("double")))


def chi_square_2x2(df: DataFrame, a: Column, b: Column, by: Sequence[str] = (), correction: bool = True) -> DataFrame:
    """Independence of two flags with the continuity correction. NULL when a row or column is empty."""
    cell = lambda x, y: F.count_if(x & y).cast("double")
    s = df.groupBy(*by).agg(cell(a, b).alias("n11"), cell(a, ~b).alias("n10"), cell(~a, b).alias("n01"),
                            cell(~a, ~b).alias("n00"))
    n = F.col("n11") + F.col("n10") + F.col("n01") + F.col("n00")
    r1, c1 = F.col("n11") + F.col("n10"), F.col("n11") + F.col("n01")
    r0, c0 = n - r1, n - c1
    gap = F.abs(F.col("n11") - F.try_divide(r1 * c1, n))       # the same in all four cells
    shift = F.least(F.lit(0.5), gap) if correction else F.lit(0.0)
    stat = (gap - shift) * (gap - shift) * F.try_divide(n * n * n, r1 * r0 * c1 * c0)
    return s.withColumn("chi2", stat).withColumn("p_value", chi2_p(F.col("chi2"), F.lit(1.0)))


def two_proportions(df: DataFrame, arm: Column, success: Column, by: Sequence[str] = (), min_arm: int = 30) -> DataFrame:
    """Pooled z-test of treatment (``arm`` true) against control with Wilson intervals and lift.

    ``enough`` tells whether both arms have ``min_arm`` rows, as the normal approximation asks for; the statistics do not depend on it.
    """
    s = df.where(success.isNotNull()).groupBy(*by).agg(
        F.count_if(arm).alias("n_treatment"), F.count_if(~arm).alias("n_control"),
        F.count_if(arm & success).alias("x_treatment"), F.count_if(~arm & success).alias("x_control"))
    enough = (F.col("n_treatment") >= min_arm) & (F.col("n_control") >= min_arm)
    p = {g: F.try_divide(F.col(f"x_{g}") * F.lit(1.0), F.col(f"n_{g}")) for g in ("treatment", "control")}
    pooled = F.try_divide((F.col("x_treatment") + F.col("x_control")) * F.lit(1.0),
                          F.col("n_treatment") + F.col("n_control"))
    error = F.sqrt(pooled * (F.lit(1.0) - pooled)
                   * (F.try_divide(F.lit(1.0), "n_treatment") + F.try_divide(F.lit(1.0), "n_control")))
    out = s.withColumns({
        "rate_treatment": p["treatment"], "rate_control": p["control"],
        "lift_pct": F.coalesce(F.try_divide((p["treatment"] - p["control"]) * 100, p["control"]), F.lit(0.0)),
        "z_stat": F.try_divide(p["treatment"] - p["control"], error), "enough": enough})
    for g in ("treatment", "control"):
        n, z2 = F.col(f"n_{g}"), Z95 * Z95
        spread = F.try_divide(F.lit(1.0), F.lit(1.0) + F.try_divide(F.lit(z2), n))
        centre = (p[g] + F.try_divide(F.lit(z2), n * 2)) * spread
        margin = F.sqrt(F.try_divide(p[g] * (F.lit(1.0) - p[g]), n) + F.try_divide(F.lit(z2), n * n * 4)) * Z95 * spread
        out = out.withColumns({f"low_{g}": centre - margin, f"high_{g}": centre + margin})
    return out.withColumn("p_value", normal_p("z_stat"))


def ab_arm(key: str, salt: str) -> Column:
    """Deterministic half split: odd last hex digit of the salted MD5 is the treatment."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.col(key).cast("string")))
    return F.substring(digest, 32, 1).isin("1", "3", "5", "7", "9", "b", "d", "f")


def paired_t(df: DataFrame, before: str, after: str, by: Sequence[str] = ()) -> DataFrame:
    """Paired t-test of ``after - before`` on rows having both."""
    d = F.col(after) - F.col(before)
    s = df.groupBy(*by).agg(F.count(d).alias("n"), F.avg(d).alias("mean_diff"), F.stddev_samp(d).alias("std_diff"))
    t = F.try_divide(F.col("mean_diff") * F.sqrt("n"), F.col("std_diff"))
    return s.withColumn("t_stat", t).withColumn("p_value", t_p(F.col("t_stat"), (F.col("n") - 1).cast("double")))


def welch_t(stats: DataFrame) -> DataFrame:
    """t-test of two group means given n, mean and std of each (``n1, mean1, std1, n2, ...``)."""
    v1, v2 = (F.col(f"std{i}") * F.col(f"std{i}") / F.col(f"n{i}") for i in (1, 2))
    dof = (v1 + v2) * (v1 + v2) / (v1 * v1 / (F.col("n1") - 1) + v2 * v2 / (F.col("n2") - 1))
    return stats.withColumn("t_stat", (F.col("mean1") - F.col("mean2")) / F.sqrt(v1 + v2)).withColumn(
        "dof", dof).withColumn("p_value", t_p("t_stat", "dof"))


def ks_two_sample(df: DataFrame, value: str, first: Column) -> DataFrame:
    """Largest gap between the two samples' cumulative shares.

    Works on distinct values and accumulates over range slices, so no task sees a whole sample.
    """
    known = df.where(F.col(value).isNotNull() & first.isNotNull())
    sizes = known.agg(F.struct(F.count_if(first).alias("n1"), F.count_if(~first).alias("n2"))).scalar()
    steps = known.groupBy(value).agg(F.count_if(first).alias("c1"), F.count_if(~first).alias("c2")).select(
        value, (F.try_divide(F.col("c1"), sizes["n1"]) - F.try_divide(F.col("c2"), sizes["n2"])).alias("_gap"))
    gaps = running_total(steps, "_gap", [value], out="_cum")
    return gaps.agg(F.max(F.abs("_cum")).alias("d_stat")).select(
        "d_stat", sizes["n1"].alias("n1"), sizes["n2"].alias("n2")).withColumn(
        "p_value", ks_p("d_stat", F.col("n1").cast("double"), F.col("n2").cast("double")))


def cell_variances(df: DataFrame, factors: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*factors).agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                                    F.var_samp(value).alias("variance"))


def widest_cell(df: DataFrame, factors: Sequence[str], value: str) -> DataFrame:
    """The factor combination with the largest variance."""
    return cell_variances(df, factors, value).where("variance is not null").orderBy(
        F.desc("variance"), *factors).limit(1)


def _additive(cells: DataFrame) -> tuple[float, float, int, int]:
    """Sums of squares explained by ``a + b`` and by ``a`` alone over the cells ``a, b, n, s``, and the number of levels of each.

    With the effects of ``a`` eliminated, those of ``b`` solve one linear system. It is never built: a product with it is two grouped sums
    over the cells, and conjugate gradients, scaled by the level sizes, need a few of them.
    """
    of_a = durable(cells.groupBy("a").agg(F.sum("n").alias("na"), F.sum("s").alias("sa")))
    joined = durable(cells.join(of_a, "a"))
    state = durable(joined.groupBy("b").agg(F.sum("n").alias("nb"), F.sum(F.col("s") - F.col("n") * F.col("sa") / F.col("na")).alias("r")).select(
        "b", "nb", F.lit(0.0).alias("beta"), "r", (F.col("r") / F.col("nb")).alias("p"), F.col("r").alias("r0")))
    alone, levels_a = of_a.agg(F.sum(F.col("sa") * F.col("sa") / F.col("na")), F.count(F.lit(1))).first()
    start, levels_b = state.agg(F.sum(F.col("r") * F.col("r") / F.col("nb")), F.count(F.lit(1))).first()
    left = start
    for _ in range(2 * levels_b):
        if not left or left <= 1e-24 * start:
            break
        pulled = joined.join(state.select("b", "p"), "b").groupBy("a").agg((F.sum(F.col("n") * F.col("p")) / F.max("na")).alias("mean"))
        moved = joined.join(pulled, "a").groupBy("b").agg(F.sum(F.col("n") * F.col("mean")).alias("q"))
        stepped = durable(state.join(moved, "b").withColumn("q", F.col("nb") * F.col("p") - F.col("q")))
        curve = stepped.agg(F.sum(F.col("p") * F.col("q"))).first()[0]
        if curve <= 1e-14 * left:                                       # what is left moves all levels alike
            break
        step = left / curve
        state = stepped.select("b", "nb", (F.col("beta") + step * F.col("p")).alias("beta"), (F.col("r") - step * F.col("q")).alias("r"), "p", "r0")
        now = state.agg(F.sum(F.col("r") * F.col("r") / F.col("nb"))).first()[0]
        state = durable(state.withColumn("p", F.col("r") / F.col("nb") + (now / left) * F.col("p")))
        left = now
    gain = state.agg(F.sum(F.col("beta") * F.col("r0"))).first()[0]
    return alone + gain, alone, levels_a, levels_b


def two_way_anova(df: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """Type II sums of squares with interaction; rows with a NULL factor or value are left out.

    Spark reduces the table to one row per cell and fits the main effects over the cells; only sums reach the driver, however many levels there are.
    """
    rows = df.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(value).cast("double").alias("x")).dropna()
    centre = rows.agg(F.avg("x")).first()[0]
    if centre is None:
        raise ValueError("no complete rows to fit")
    cells = durable(rows.groupBy("a", "b").agg(F.count("x").alias("n"), (F.sum(F.col("x") - centre)).alias("s"), (F.var_pop("x") * F.count("x")).alias("within")))
    between, n_cells, n, within = cells.agg(F.sum(F.col("s") * F.col("s") / F.col("n")), F.count(F.lit(1)), F.sum("n"), F.sum("within")).first()
    both, a_alone, levels_a, levels_b = _additive(cells)
    b_alone = cells.groupBy("b").agg((F.sum("s") * F.sum("s") / F.sum("n")).alias("ss")).agg(F.sum("ss")).first()[0]
    dof_a, dof_b, dof_rest = levels_a - 1, levels_b - 1, n - n_cells
    parts = [(a, both - b_alone, dof_a), (b, both - a_alone, dof_b), (f"{a}:{b}", between - both, n_cells - 1 - dof_a - dof_b)]
    base = within / dof_rest if dof_rest else None
    out = []
    for term, ss, dof in parts:
        if dof:
            f = max(ss, 0.0) / dof / base if base else None
            out.append((term, max(ss, 0.0), float(dof), f, None if f is None else f_tail(f, dof, dof_rest)))
    out.append(("residual", within, float(dof_rest), None, None))
    return df.sparkSession.createDataFrame(out, "term string, sum_sq double, dof double, f_stat double, p_value double")


def ols(df: DataFrame, response: Column, features: dict[str, Column]) -> DataFrame:
    """Least squares from one pass over the cross products; coefficient table with 95% intervals."""
    coef, cov, dof, names = _ols_fit(df, response, features)
    se = np.sqrt(np.diag(cov))
    rows = []
    for i, name in enumerate(names):
        t = float(coef[i] / se[i]) if se[i] > 0 else None
        p = t_two_sided(t, dof) if t is not None else None
        rows.append((name, float(coef[i]), float(se[i]), t, p, float(coef[i] - Z95 * se[i]), float(coef[i] + Z95 * se[i])))
    return df.sparkSession.createDataFrame(
        rows, "term string, coef double, std_err double, t_stat double, p_value double, low double, high double")


def elasticities(df: DataFrame, response: Column, driver: Column, group: Column, lift_pct: float = 10.0) -> DataFrame:
    """Slope of ``response`` on ``driver`` inside and outside ``group`` with intervals and the effect of a lift."""
    g = group.cast("double")
    coef, cov, _, names = _ols_fit(df, response, {"driver": driver, "driver_x_group": driver * g, "group": g})
    d, x = names.index("driver"), names.index("driver_x_group")
    base, moved = float(coef[d]), float(coef[d] + coef[x])
    errors = [float(np.sqrt(cov[d, d])), float(np.sqrt(max(cov[d, d] + cov[x, x] + 2 * cov[d, x], 0.0)))]
    rows = [(label, slope, se, slope - Z95 * se, slope + Z95 * se, slope * lift_pct)
            for label, slope, se in zip(("others", "group"), (base, moved), errors)]
    return df.sparkSession.createDataFrame(
        rows, "part string, elasticity double, std_err double, low double, high double, lift_effect_pct double")


def _ols_fit(df: DataFrame, response: Column, features: dict[str, Column]):
    names = ["const", *features]
    cols = [F.lit(1.0), *[c.cast("double") for c in features.values()], response.cast("double")]
    rows = df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).dropna()
    k = len(cols)
    shift = rows.agg(*[F.avg(f"c{i}").alias(f"m{i}") for i in range(1, k)]).first()
    if shift[0] is None:
        raise ValueError("no complete rows to fit")
    # centred on the means, so the cross products lose no digits
    centred = [F.col("c0"), *[F.col(f"c{i}") - F.lit(float(shift[i - 1])) for i in range(1, k)]]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = rows.agg(*[F.sum(centred[i] * centred[j]).alias(f"s{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((k, k))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = sums[f"s{i}_{j}"]
    xx, xy, yy = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1]
    inverse = np.linalg.pinv(xx, hermitian=True)
    beta = inverse @ xy
    dof = int(gram[0, 0]) - (k - 1)
    sigma2 = max(yy - float(beta @ xy), 0.0) / dof
    cov = inverse * sigma2
    # undo the centring: only the constant changes
    back = np.eye(k - 1)
    back[0, 1:] = [-float(m) for m in shift[:k - 2]]
    coef = back @ beta
    coef[0] += float(shift[k - 2])
    return coef, back @ cov @ back.T, dof, names
