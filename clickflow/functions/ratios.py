"""Guarded ratios and numeric formatting (JVM-side column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def guarded_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0`` else 0 (never NULL, never raises)."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, F.try_divide(num, den)).otherwise(F.lit(0.0))


def guarded_dropoff(num, den) -> Column:
    """``1 - num / den`` when ``den > 0`` else 0."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, F.lit(1.0) - F.try_divide(num, den)).otherwise(F.lit(0.0))


def safe_ratio(num, den) -> Column:
    """Report-style ratio: NULL/zero denominator gives 0 (pandas NaN -> 0)."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den)), F.lit(0.0))


def percent(num, den) -> Column:
    return safe_ratio(num, den) * F.lit(100.0)


def safe_float(x, decimals: int = 4) -> Column:
    """NULL to 0, rounded (HALF_UP; see README on rounding)."""
    return F.coalesce(F.round(_c(x).cast("double"), decimals), F.lit(0.0))


def safe_int(x) -> Column:
    """NULL to 0, truncated toward zero."""
    return F.coalesce(_c(x).cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))
