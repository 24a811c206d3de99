"""Typed rows from staged text, with reasons for refusal (SNK-2, DQ-7, DQ-16).

Every layer keeps every row: a refused row carries a text in ``_reject`` and is
left out by readers, not deleted. That makes row conservation checkable and
costs one column instead of a second pass over the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.functions import (
    active_flag,
    gross_revenue,
    join_text,
    status_or_unknown,
    typed,
)
from roadledger.model import Source

REJECT = "_reject"
COPIES = "_copies"
MALFORMED = "_malformed"
RAW_LINE = "_raw_line"


def first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """Text of the first rule that holds, NULL when none does."""
    return F.coalesce(*[F.when(broken, F.lit(text)) for broken, text in rules])


def type_source(staged: DataFrame, source: Source) -> DataFrame:
    """All declared columns typed, plus ``_reject``.

    A row is refused when the line was short, its natural key is blank, or a
    required column holds no usable value. Foreign keys are never required: a
    blank one becomes the Unknown member later.
    """
    columns = [typed(F.col(n), kind).alias(n) for n, kind, _ in source.columns]
    must = [*source.required]
    must += [k for k in source.key if k not in source.parents and k not in must]
    malformed = MALFORMED in staged.columns
    declared = {*source.column_names, RAW_LINE}
    extra = [c for c in staged.columns if c not in declared]
    out = staged.select(*columns, *extra)
    rules = [(F.col(MALFORMED), "short line")] if malformed else []
    rules += [(F.col(c).isNull(), f"missing {c}") for c in must]
    return out.withColumn(REJECT, first_reason(rules)).drop(MALFORMED)


def silver_reasons(frame: DataFrame) -> DataFrame:
    """Refused rows per reason."""
    return (
        frame.where(F.col(REJECT).isNotNull())
        .groupBy(F.col(REJECT).alias("reason"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def derive(frame: DataFrame, source: Source) -> DataFrame:
    """Add the computed columns of a silver table."""
    if source.name == "drivers":
        status = status_or_unknown(F.col("employment_status"))
        return frame.withColumns(
            {
                "full_name": join_text(F.col("first_name"), " ", F.col("last_name")),
                "employment_status": status,
                "is_active": active_flag(status),
            }
        )
    if source.name in ("trucks", "trailers"):
        status = status_or_unknown(F.col("status"))
        return frame.withColumns({"status": status, "is_active": active_flag(status)})
    if source.name == "customers":
        status = status_or_unknown(F.col("account_status"))
        return frame.withColumns(
            {"account_status": status, "is_active": active_flag(status)}
        )
    if source.name == "routes":
        origin, destination = F.col("origin_city"), F.col("destination_city")
        return frame.withColumns(
            {
                "origin_full": join_text(origin, ", ", F.col("origin_state")),
                "destination_full": join_text(
                    destination, ", ", F.col("destination_state")
                ),
                "corridor": join_text(origin, " -> ", destination),
            }
        )
    if source.name == "loads":
        return frame.withColumn("gross_revenue", gross_revenue())
    return frame


def duplicate_keys(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (DQ-6, DQ-9).

    Only the key columns are read and they are counted before the shuffle.
    """
    return (
        frame.where(F.col(REJECT).isNull() if REJECT in frame.columns else F.lit(True))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def refuse_duplicates(
    frame: DataFrame, repeated: DataFrame, key: Sequence[str]
) -> DataFrame:
    """Keep one row per natural key and refuse the surplus.

    ``repeated`` is the stored result of ``duplicate_keys``, so its size is known
    to the planner. Only rows of repeated keys are grouped, and equal rows are
    counted before they meet. The row kept is the smallest by value, which does
    not depend on task order. Surplus rows with equal content are stored once
    with their number in ``_copies``.
    """
    names = [c for c in frame.columns if c != REJECT]
    marks = repeated.select(*key, F.lit(True).alias("_repeats"))
    marked = frame.join(marks, list(key), "left")
    contested = F.col(REJECT).isNull() & F.col("_repeats").isNotNull()
    settled = marked.where(~contested).select(
        *names, REJECT, F.lit(1).cast("bigint").alias(COPIES)
    )
    contents = (
        marked.where(contested).groupBy(*names).agg(F.count(F.lit(1)).alias(COPIES))
    )
    content = F.struct(*[F.col(c) for c in names])
    kept = contents.groupBy(*key).agg(F.min(content).alias("_kept"))
    kept_rows = kept.select(
        *[F.col(f"_kept.{c}").alias(c) for c in names],
        F.lit(None).cast("string").alias(REJECT),
        F.lit(1).cast("bigint").alias(COPIES),
    )
    same = content.eqNullSafe(F.col("_kept"))
    surplus = (
        contents.join(kept, list(key))
        .withColumn(COPIES, F.col(COPIES) - F.when(same, 1).otherwise(0))
        .where(F.col(COPIES) > 0)
        .select(*names, F.lit("repeated key").alias(REJECT), COPIES)
    )
    return settled.unionByName(kept_rows).unionByName(surplus)


def single_copies(frame: DataFrame) -> DataFrame:
    """Rows of a table without repeated keys, each standing for itself."""
    return frame.withColumn(COPIES, F.lit(1).cast("bigint"))


def refuse_outside(
    frame: DataFrame, column: str, start: str, end: str
) -> DataFrame:
    """Refuse accepted rows whose date is missing or outside the calendar."""
    day = F.to_date(F.col(column))
    inside = day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    reason = first_reason(
        [(day.isNull(), f"missing {column}"), (~inside, f"{column} outside calendar")]
    )
    return frame.withColumn(REJECT, F.coalesce(REJECT, reason))


def accepted_only(frame: DataFrame) -> DataFrame:
    """The rows readers see."""
    return frame.where(F.col(REJECT).isNull()).drop(REJECT, COPIES)
