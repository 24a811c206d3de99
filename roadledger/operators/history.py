"""Incremental merge and versioned dimensions (RM-1, RM-3, RM-4)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadledger.model import UNKNOWN_SK
from roadledger.operators.conform import probe
from roadledger.operators.ranking import first_by
from roadledger.operators.staging import COPIES, REJECT
from roadledger.sources.tables import Warehouse, shared_folder

SUPERSEDED = "superseded"


def merge_latest(
    base: DataFrame, changes: DataFrame, key: Sequence[str], order: Column
) -> DataFrame:
    """Per key the row with the largest ``order`` of ``base`` and ``changes``.

    The stored row competes like any change, so a change that is older than it has
    no effect, whenever it arrives and however changes are split into batches. Both
    frames have the columns that ``order`` names; include a tie-break. A missing
    order is the smallest. Keys new to ``base`` are added. Rows are reduced per key
    before the one shuffle.
    """
    rest = [c for c in base.columns if c not in key]
    every = base.unionByName(changes.select(*base.columns))
    return first_by(every, key, F.struct(order), rest).select(*base.columns)


def upsert(
    warehouse: Warehouse,
    layer: str,
    table: str,
    changes: DataFrame,
    key: Sequence[str],
    order: Column,
    partition_by: Sequence[str],
    staging: str | None = None,
) -> None:
    """Merge ``changes`` into a stored table, rewriting touched partitions only.

    The table must have been written before, be it without rows. A stored row
    competes with the changes: only a change of larger ``order`` replaces it, so the
    columns that ``order`` names are stored with the row, and rows stored without
    them come before every change.

    A replaced row leaves its partition; if the new row belongs to another one,
    the old row stays behind, refused as superseded, so that no partition is
    left to be emptied. Running the same changes again changes nothing.

    The new partitions are first written to ``staging`` because they are computed
    from the very files they replace: a folder on shared storage no other run
    uses, by default a new one under the session's checkpoint folder.
    """
    keys, parts = list(key), list(partition_by)
    spark = warehouse.spark
    staging = staging or f"{shared_folder(spark)}/upsert/{uuid.uuid4().hex}"
    names = changes.columns
    columns = StructType(list(changes.schema.fields))
    columns = columns.add(REJECT, "string").add(COPIES, "long")
    stored = spark.read.schema(columns).parquet(warehouse.path(layer, table))
    rest = [c for c in names if c not in keys]
    accepted = stored.where(F.col(REJECT).isNull())
    newest = first_by(changes, keys, order, rest).withColumn("_order", F.struct(order))
    held = accepted.select(*keys, F.struct(order).alias("_held"))
    latest = newest.join(held, keys, "left").where(
        F.col("_held").isNull() | (F.col("_order") > F.col("_held"))
    )
    latest = latest.select(*names)
    moved_to = latest.select(*keys, *[F.col(p).alias(f"_new_{p}") for p in parts])

    hit = accepted.select(*keys, *parts).join(latest.select(*keys), keys, "left_semi")
    touched = hit.select(*parts).unionByName(latest.select(*parts)).distinct()
    same_place = F.lit(True)
    for p in parts:
        same_place = same_place & F.col(p).eqNullSafe(F.col(f"_new_{p}"))
    live = F.col(REJECT).isNull() & F.col("_changed")
    affected = stored.join(touched, parts, "left_semi").join(
        moved_to.withColumn("_changed", F.lit(True)), keys, "left"
    )
    kept = (
        affected.where(~F.coalesce(live & same_place, F.lit(False)))
        .withColumn(REJECT, F.when(live, F.lit(SUPERSEDED)).otherwise(F.col(REJECT)))
        .select(*stored.columns)
    )
    fresh = latest.withColumns(
        {REJECT: F.lit(None).cast("string"), COPIES: F.lit(1).cast("bigint")}
    ).select(*stored.columns)
    kept.unionByName(fresh).write.mode("overwrite").parquet(staging)
    warehouse.replace_partitions(spark.read.parquet(staging), layer, table, parts)


def versions(
    observed: DataFrame, key: str, day: str, attributes: Sequence[str], order: Column
) -> DataFrame:
    """Type 2 history: one row per key and period of unchanged attributes.

    ``observed`` holds sightings of a member; of several on one day the one with
    the largest ``order`` counts. ``valid_to`` is the last day of the period,
    NULL for the current one. Sightings shrink to one per key and day before
    the window, which bounds a window partition by the calendar.
    """
    names = list(attributes)
    daily = first_by(observed, [key, day], order, names)
    timeline = Window.partitionBy(key).orderBy(day)
    now = F.struct(*names)
    changed = daily.withColumn("_before", F.lag(now).over(timeline)).where(
        ~F.col("_before").eqNullSafe(now)
    )
    next_day = F.lead(day).over(timeline)
    return changed.select(
        key,
        *names,
        F.col(day).alias("valid_from"),
        F.date_sub(next_day, 1).alias("valid_to"),
        next_day.isNull().alias("is_current"),
    )


def as_of(
    fact: DataFrame, history: DataFrame, key: str, day: str, attributes: Sequence[str]
) -> DataFrame:
    """Each fact row with the attributes valid on its day; NULL if none were.

    Periods are first laid out over the months in which the key has facts, so a fact
    row meets the periods of its own key and month only: at most one per day,
    however long the key's history is and however many facts it has.
    """
    month = F.trunc(F.col(day), "month")
    months = fact.select(F.col(key).alias("_key"), month.alias("_month")).distinct()
    periods = history.select(
        F.col(key).alias("_key"), "valid_from", "valid_to", *attributes
    )
    open_in = (F.col("valid_from") <= F.last_day("_month")) & (
        F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_month"))
    )
    monthly = months.join(periods, "_key").where(open_in)
    valid = (
        (F.col(key) == F.col("_key"))
        & (month == F.col("_month"))
        & (F.col(day) >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col(day) <= F.col("valid_to")))
    )
    return fact.join(monthly, valid, "left").drop(
        "_key", "_month", "valid_from", "valid_to"
    )


def with_version(
    fact: DataFrame,
    history: DataFrame,
    key: str,
    day: str,
    sk: str,
    spread_by: Sequence[str],
) -> DataFrame:
    """The fact with ``sk``, the version of its member that was valid on its day.

    A member's first version also covers the days before it was first seen. A missing,
    Unknown or unheard-of member and a missing day give the Unknown surrogate; the row
    stays. As in ``as_of``, a row meets the periods of its own key and month only; rows
    without a usable key are spread by the columns ``spread_by``.
    """
    first = F.min("valid_from").over(Window.partitionBy(key))
    periods = history.where(F.col(sk) != UNKNOWN_SK).select(
        F.col(key).alias("_key"),
        F.col(sk).alias("_version"),
        F.when(F.col("valid_from") > first, F.col("valid_from")).alias("_from"),
        F.col("valid_to").alias("_to"),
    )
    on = F.to_date(F.col(day))
    month = F.trunc(on, "month")
    months = (
        fact.select(F.col(key).alias("_key"), month.alias("_month"))
        .where("_key IS NOT NULL AND _month IS NOT NULL")
        .distinct()
    )
    open_in = (F.col("_from").isNull() | (F.col("_from") <= F.last_day("_month"))) & (
        F.col("_to").isNull() | (F.col("_to") >= F.col("_month"))
    )
    monthly = months.join(periods, "_key").where(open_in)
    valid = (
        (F.col("_probe") == F.col("_key"))
        & (month == F.col("_month"))
        & (F.col("_from").isNull() | (on >= F.col("_from")))
        & (F.col("_to").isNull() | (on <= F.col("_to")))
    )
    return (
        fact.withColumn("_probe", probe(key, spread_by))
        .join(monthly, valid, "left")
        .select(
            *[F.col(c) for c in fact.columns],
            F.coalesce("_version", F.lit(UNKNOWN_SK).cast("bigint")).alias(sk),
        )
    )
