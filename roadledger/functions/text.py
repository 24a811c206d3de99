"""String cleaning (PRJ-1, PRJ-6, PRJ-8, PRJ-10, PRJ-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_STATUS = "Unknown"
ACTIVE_STATUS = "Active"


def clean(c: Column) -> Column:
    """Strip surrounding blanks; an empty result is NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def flag3(c: Column) -> Column:
    """'True'/'False' text to a three-valued boolean.

    Letter case and trailing blanks do not matter; any other text is NULL.
    """
    word = F.lower(F.rtrim(c))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def join_text(*parts: Column | str) -> Column:
    """Concatenate; NULL when any part is NULL. Plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def status_or_unknown(c: Column) -> Column:
    """A missing status reads 'Unknown'."""
    return F.coalesce(c, F.lit(UNKNOWN_STATUS))


def active_flag(status: Column) -> Column:
    """True for an active status, False for any other, also for a missing one."""
    return F.coalesce(status == ACTIVE_STATUS, F.lit(False))
