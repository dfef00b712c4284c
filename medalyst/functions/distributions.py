"""Tail probabilities for the handful of statistics a test produces.

Only ever applied to result rows (one per test or group), through the Arrow
UDFs at the end of the file; the sufficient statistics come from Spark.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# workers get these helpers with the task, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_EPS = 1e-14


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: series below a+1, continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * _EPS:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * scale
    b = x + 1 - a
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or _TINY)
        c = b + an / c or _TINY
        step = d * c
        h *= step
        if abs(step - 1) < _EPS:
            break
    return scale * h


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or _TINY)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + num * d or _TINY)
            c = 1 + num / c or _TINY
            h *= d * c
        if abs(d * c - 1) < _EPS:
            break
    return h


def _beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def chi2_tail(stat: float, dof: float) -> float:
    return _gamma_upper(dof / 2.0, stat / 2.0)


def t_two_sided(t: float, dof: float) -> float:
    return _beta(dof / 2.0, 0.5, dof / (dof + t * t))


def f_tail(f: float, dof_num: float, dof_den: float) -> float:
    return _beta(dof_den / 2.0, dof_num / 2.0, dof_den / (dof_den + dof_num * f))


def ks_tail(d: float, n: float, m: float) -> float:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value."""
    lam = d * math.sqrt(n * m / (n + m))
    if lam < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * total))


def _rowwise(fn, *series: pd.Series) -> pd.Series:
    rows = zip(*series)
    return pd.Series([None if any(pd.isna(v) for v in r) else fn(*r) for r in rows], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _rowwise(normal_two_sided, z)


@F.pandas_udf(T.DoubleType())
def chi2_p(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return _rowwise(chi2_tail, stat, dof)


@F.pandas_udf(T.DoubleType())
def t_p(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return _rowwise(t_two_sided, stat, dof)


@F.pandas_udf(T.DoubleType())
def f_p(stat: pd.Series, dof_num: pd.Series, dof_den: pd.Series) -> pd.Series:
    return _rowwise(f_tail, stat, dof_num, dof_den)


@F.pandas_udf(T.DoubleType())
def ks_p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return _rowwise(ks_tail, d, n, m)
