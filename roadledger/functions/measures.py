"""Business measures (PRJ-11, PRJ-16..19, PRJ-22, AGG-5, AGG-8, AGG-9).

Ratios are exact decimals. The operand types leave the quotient at least 14
fractional digits, so rounding it once more to ``scale`` is safe.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERATOR = "decimal(26,4)"
DENOMINATOR = "decimal(20,2)"
RATIO_SCALE = 4


def safe_ratio(a: Column, b: Column, scale: int = RATIO_SCALE) -> Column:
    """``a / b`` rounded half up; NULL when either is NULL or ``b`` is zero."""
    quotient = F.try_divide(a.cast(NUMERATOR), b.cast(DENOMINATOR))
    return F.round(quotient, scale).cast(f"decimal(24,{scale})")


def pct(part: Column, whole: Column, scale: int = 1) -> Column:
    """Percentage of ``whole``, one decimal by default, NULL for an empty whole."""
    return safe_ratio(part.cast(NUMERATOR) * F.lit(100), whole, scale)


def exact_mean(c: Column, scale: int = RATIO_SCALE) -> Column:
    """Mean over non-NULL values as sum over count, without a float in between."""
    return safe_ratio(F.sum(c), F.count(c), scale)


def sum0(c: Column) -> Column:
    """Sum that reads 0, not NULL, when the group has no value."""
    return F.coalesce(F.sum(c), F.lit(0))


def gross_revenue(
    revenue: str = "revenue",
    surcharge: str = "fuel_surcharge",
    accessorial: str = "accessorial_charges",
) -> Column:
    """Revenue plus both charges; NULL when any of the three is missing."""
    return F.col(revenue) + F.col(surcharge) + F.col(accessorial)


def late_minutes(scheduled: Column, actual: Column) -> Column:
    """Signed lateness in minutes, exact to the second."""
    seconds = F.timestamp_diff("SECOND", scheduled, actual)
    return safe_ratio(seconds, F.lit(60), 2)


def month_key(c: Column) -> Column:
    """'yyyy-MM'."""
    return F.date_format(c, "yyyy-MM")


def format_n0(c: Column) -> Column:
    """Thousands separators, no decimals, rounded half up before formatting."""
    return F.format_number(F.round(c.cast("decimal(30,4)"), 0), 0)
