"""Column helpers: text cleaning, tolerant typing and business measures."""

from roadledger.functions.casts import (
    prefix_date,
    to_date,
    to_decimal,
    to_int,
    to_timestamp,
    typed,
)
from roadledger.functions.measures import (
    exact_mean,
    format_n0,
    gross_revenue,
    late_minutes,
    month_key,
    pct,
    safe_ratio,
    sum0,
)
from roadledger.functions.text import (
    active_flag,
    clean,
    flag3,
    join_text,
    status_or_unknown,
)

__all__ = [
    "active_flag",
    "clean",
    "exact_mean",
    "flag3",
    "format_n0",
    "gross_revenue",
    "join_text",
    "late_minutes",
    "month_key",
    "pct",
    "prefix_date",
    "safe_ratio",
    "status_or_unknown",
    "sum0",
    "to_date",
    "to_decimal",
    "to_int",
    "to_timestamp",
    "typed",
]
