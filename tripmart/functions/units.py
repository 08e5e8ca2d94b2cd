"""Unit conversion and small arithmetic Column helpers.

Exact integer units: cents, millimiles, whole seconds. Null in, null out. Rounding is
half-to-even (``rint``), the same as Python ``round``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_cents(col: Column | str) -> Column:
    """Dollars -> integer cents. NaN and infinities map to null."""
    x = _c(col)
    ok = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.when(ok, F.rint(x * 100.0).cast("bigint"))


def to_millimiles(col: Column | str) -> Column:
    """Miles -> integer millimiles. NaN and infinities map to null."""
    x = _c(col)
    ok = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.when(ok, F.rint(x * 1000.0).cast("bigint"))


def whole_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds between two timestamps (truncated like a total-seconds integer)."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def key_or_zero(col: Column | str) -> Column:
    """P20: null id -> 0, as int."""
    return F.coalesce(_c(col).cast("int"), F.lit(0))


def percent_delta(current: Column | str, prior: Column | str) -> Column:
    """H5: 100 * (current - prior) / prior, null when the prior is null or zero."""
    cur, pri = _c(current).cast("double"), _c(prior).cast("double")
    return F.when(pri.isNotNull() & (pri != 0.0), F.lit(100.0) * (cur - pri) / pri)


def safe_ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``scale * num / NULLIF(den, 0)`` in double, operation order kept fixed."""
    den = denominator.cast("double")
    return F.when(den != 0.0, (F.lit(float(scale)) * numerator.cast("double")) / den)


def int_div(numerator: Column, denominator: Column) -> Column:
    """Integral division (SQL ``div``), exact for bigint."""
    return F.call_function("div", numerator, denominator)


def round_half_up_ratio(numerator: Column, denominator: Column) -> Column:
    """Exact ROUND(num / den) half away from zero for num >= 0, den > 0, as bigint; null when den = 0."""
    num, den = numerator.cast("bigint"), denominator.cast("bigint")
    return F.when(den != 0, int_div(num * 2 + den, den * 2))
