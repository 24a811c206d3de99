"""Tolerant typing of source text (PRJ-2..5, PRJ-7).

A value that does not fit becomes NULL and never fails the job. The accepted
spellings are stated as patterns because a bare ``try_cast`` takes forms the
warehouse must refuse ('1e3' as a decimal, '2022-01' as a date).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadledger.functions.text import clean, flag3

INT_TEXT = r"^[+-]?[0-9]+$"
DECIMAL_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,7})?)?)?$"


def _guarded(text: Column, pattern: str, result: Column) -> Column:
    return F.when(text.rlike(pattern), result)


def to_int(c: Column) -> Column:
    text = clean(c)
    return _guarded(text, INT_TEXT, text.try_cast("int"))


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Extra digits round half up; a value too large for the type is NULL."""
    text = clean(c)
    return _guarded(text, DECIMAL_TEXT, text.try_cast(f"decimal({precision},{scale})"))


def to_date(c: Column) -> Column:
    """ISO date, or the date part of an ISO timestamp."""
    text = clean(c)
    return _guarded(text, DATE_TEXT, F.substring(text, 1, 10).try_cast("date"))


def prefix_date(c: Column) -> Column:
    """Date from the first ten characters, whatever follows them."""
    return to_date(F.substring(c, 1, 10))


def to_timestamp(c: Column) -> Column:
    """ISO timestamp without a zone, rounded to the nearest second."""
    text = clean(c)
    exact = text.try_cast("timestamp_ntz")
    shifted = exact + F.expr("interval '0.5' second")
    second = F.date_part(F.lit("SECOND"), shifted)
    zero = F.lit(0)
    fraction = F.make_dt_interval(zero, zero, zero, second - F.floor(second))
    return _guarded(text, DATE_TEXT, shifted - fraction)


def typed(c: Column, kind: str) -> Column:
    """Type one source column by its declared kind.

    Kinds: key, text, int, flag, date, date10, timestamp, decimal(p,s).
    """
    if kind in ("key", "text"):
        return clean(c)
    if kind == "int":
        return to_int(c)
    if kind == "flag":
        return flag3(clean(c))
    if kind == "date":
        return to_date(c)
    if kind == "date10":
        return prefix_date(c)
    if kind == "timestamp":
        return to_timestamp(c)
    if kind.startswith("decimal("):
        precision, scale = kind[len("decimal(") : -1].split(",")
        return to_decimal(c, int(precision), int(scale))
    raise ValueError(f"unknown column kind: {kind}")
