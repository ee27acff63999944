"""Scalar column functions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Missing values are SQL NULL, never NaN (NaN compares greater than any number
in Spark and would silently turn into "late").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_between(end, start) -> Column:
    """whole days from ``start`` to ``end`` (never an interval)."""
    return F.datediff(_c(end), _c(start))


def runout(date, days) -> Column:
    """day the supply runs out = pickup day + supply days."""
    return F.date_add(_c(date), _c(days).cast("int"))


def age_365(date, birth) -> Column:
    """age as whole (days / 365), truncated."""
    return (F.datediff(_c(date), _c(birth)) / F.lit(365)).cast("int")


def age_calendar(date, birth) -> Column:
    """completed calendar years between birth and date."""
    d, b = _c(date), _c(birth)
    years = F.year(d) - F.year(b)
    before_birthday = (F.month(d) < F.month(b)) | ((F.month(d) == F.month(b)) & (F.dayofmonth(d) < F.dayofmonth(b)))
    return (years - F.when(before_birthday, 1).otherwise(0)).cast("int")


def dow(date) -> Column:
    """weekday with Monday = 0."""
    return F.weekday(_c(date))


def month(date) -> Column:
    """calendar month 1..12."""
    return F.month(_c(date))


def to_date(col, fmt: str | None = None) -> Column:
    """text or timestamp to date."""
    return F.to_date(_c(col), fmt) if fmt else F.to_date(_c(col))


def dates(lo, hi) -> Column:
    """F8: one row per day from lo to hi inclusive (use with explode)."""
    return F.explode(F.sequence(_c(lo), _c(hi), F.expr("interval 1 day")))


def clip_low(col, lo) -> Column:
    """max(col, lo) that keeps NULL as NULL (greatest() would not)."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(lo)))


def abs_pct_err(y, p, floor: float = 1.0) -> Column:
    """|y - p| / max(y, floor)."""
    return F.abs(_c(y) - _c(p)) / F.greatest(_c(y), F.lit(float(floor)))


def round_up(col, n: int) -> Column:
    """round half away from zero (SQL ROUND)."""
    return F.round(_c(col), n)


def round_even(col, n: int) -> Column:
    """round half to even (Python/pandas round)."""
    return F.bround(_c(col), n)


def psi_term(actual, expected) -> Column:
    """(a - e) * ln(a / e) for one bucket."""
    a, e = _c(actual), _c(expected)
    return (a - e) * F.log(a / e)


def ratio(num, den) -> Column:
    """num / den, NULL when den is 0 (ANSI mode would raise)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def flag(cond: Column) -> Column:
    """Missing-is-false comparison as 0/1."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def tail(arr, k: int) -> Column:
    """F16: k-th element from the end (1 = last)."""
    return F.element_at(_c(arr), -k)


def mean_slice(arr, start: int, n: int) -> Column:
    """F16: mean of ``n`` elements starting at 1-based ``start`` (negative
    counts from the end)."""
    s = F.slice(_c(arr), start, n)
    return F.aggregate(s, F.lit(0.0), lambda acc, x: acc + x) / F.lit(float(n))


def has_size(arr, n: int) -> Column:
    """array has exactly n elements."""
    return F.size(_c(arr)) == F.lit(n)


def row_mse(a, b) -> Column:
    """mean squared difference of two equally long arrays."""
    sq = F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x) / F.size(_c(a))


def any_missing(arr) -> Column:
    """any NULL inside the array."""
    return F.exists(_c(arr), lambda x: x.isNull())


def arr_sum(arr) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0), lambda acc, x: acc + x)


def arr_mean(arr) -> Column:
    """mean of an array."""
    return arr_sum(arr) / F.size(_c(arr))


def arr_std(arr) -> Column:
    """population standard deviation of an array."""
    m = arr_mean(arr)
    dev = F.aggregate(_c(arr), F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m))
    return F.sqrt(dev / F.size(_c(arr)))


def arr_last(arr) -> Column:
    """last element."""
    return F.element_at(_c(arr), -1)


def arr_share_over(arr, cut: float) -> Column:
    """share of elements strictly above ``cut``."""
    return F.size(F.filter(_c(arr), lambda x: x > F.lit(cut))) / F.size(_c(arr))


def buffered(units, buffer: float = 0.1) -> Column:
    """order quantity with a safety buffer, rounded half to even."""
    return F.bround(_c(units) * F.lit(1.0 + buffer), 0)


def band(col, cuts: list[float], labels: list[str], right_closed: bool = False) -> Column:
    """Banding by ascending thresholds.

    left-closed (default): value >= cuts[i] -> labels[i+1]; below cuts[0] -> labels[0].
    right-closed: value <= cuts[i] -> labels[i]; above the last cut -> labels[-1].
    """
    c = _c(col)
    if right_closed:
        expr = None
        for cut, lab in zip(cuts, labels):
            expr = (F.when(c <= F.lit(cut), F.lit(lab)) if expr is None
                    else expr.when(c <= F.lit(cut), F.lit(lab)))
        return expr.otherwise(F.lit(labels[-1]))
    expr = None
    for cut, lab in sorted(zip(cuts, labels[1:]), reverse=True):
        expr = (F.when(c >= F.lit(cut), F.lit(lab)) if expr is None
                else expr.when(c >= F.lit(cut), F.lit(lab)))
    return expr.otherwise(F.lit(labels[0]))
