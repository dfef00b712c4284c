"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text ---------------------------------------------------------------------

CASINGS = {"upper": F.upper, "lower": F.lower, "title": F.initcap, "keep": lambda c: c}


def tidy(c: Column | str, casing: str = "keep") -> Column:
    """Trim and recase a label."""
    return CASINGS[casing](F.trim(as_col(c)))


def tidy_multi_value(c: Column | str, missing: str = "Unknown") -> Column:
    """Multi-value text separated by one or two bars becomes ``a, b``; NULL becomes ``missing``."""
    spaced = F.regexp_replace(as_col(c), r"\s*\|{1,2}\s*", ", ")
    return F.coalesce(F.initcap(F.trim(spaced)), F.lit(missing))


def wkt_point(c: Column | str) -> tuple[Column, Column]:
    """``POINT (lon lat)`` to numeric (lon, lat); malformed text gives NULLs."""
    pattern = r"^\s*POINT\s*\(\s*(-?[0-9.]+)\s+(-?[0-9.]+)\s*\)\s*$"
    text = as_col(c)
    return tuple(F.regexp_extract(text, pattern, i).try_cast("double") for i in (1, 2))


# --- numbers ------------------------------------------------------------------

def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def clip(c: Column | str, low=None, high=None) -> Column:
    """Bound a value; NULL stays NULL."""
    x = as_col(c)
    out = x
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(x.isNotNull(), out)


def row_total(cols: Sequence[Column | str]) -> Column:
    """Sum across columns of one row; NULL counts as zero."""
    return reduce(lambda a, b: a + b, [zero_if_null(c) for c in cols])


def exact_sum(c: Column | str, scale: int = 2) -> Column:
    """Order-independent sum of a money-like double.

    Each value is counted in units of the last decimal as a whole number, which
    is several times cheaper than a decimal cast of a double. The units are
    summed as a decimal, which does not overflow on very large tables.
    """
    units = F.rint(as_col(c) * F.lit(float(10 ** scale))).cast("bigint").cast("decimal(18,0)")
    return (F.sum(units) * F.lit(Decimal(1).scaleb(-scale))).cast("double")


def exact_avg(c: Column | str, scale: int = 2) -> Column:
    """Order-independent mean of a money-like double, NULLs ignored."""
    return F.try_divide(exact_sum(c, scale), F.count(as_col(c)))


def pct(part: Column | str, whole: Column | str, digits: int = 2, half_even: bool = False) -> Column:
    """``part / whole * 100`` rounded; NULL when the whole is zero."""
    rounder = F.bround if half_even else F.round
    return rounder(F.try_divide(as_col(part) * F.lit(100.0), as_col(whole)), digits)


# --- choices ------------------------------------------------------------------

def ladder(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """First matching condition wins, as a CASE expression."""
    head, *rest = [(cond, F.lit(v) if not isinstance(v, Column) else v) for cond, v in branches]
    out = reduce(lambda acc, b: acc.when(*b), rest, F.when(*head))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def lookup(c: Column | str, table: Mapping, default=None) -> Column:
    """Small fixed dictionary as a map literal; missing keys give ``default``."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), as_col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def one_hot(c: Column | str, levels: Sequence, prefix: str, drop_first: bool = True) -> list[Column]:
    """0/1 columns per level in sorted order; NULL gives zeros everywhere."""
    kept = sorted(levels)[1 if drop_first else 0:]
    return [F.coalesce((as_col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}_{v}") for v in kept]


# --- time ---------------------------------------------------------------------

def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("SECOND", as_col(start), as_col(end))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def hours_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def calendar_months(start: Column | str, end: Column | str) -> Column:
    """Whole calendar months by year and month parts only."""
    a, b = as_col(start), as_col(end)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


def thirty_day_months(start: Column | str, end: Column | str) -> Column:
    return F.floor(F.datediff(as_col(end), as_col(start)) / F.lit(30))


def month_start(c: Column | str) -> Column:
    return F.trunc(as_col(c).cast("date"), "month")


def on_time(done: Column | str, due: Column | str) -> Column:
    """1 in time, 0 late, NULL when not done."""
    return (as_col(done) <= as_col(due)).cast("int")
