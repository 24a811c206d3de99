"""Data-quality operators DQ-3..DQ-16.

Each check reads a table once, whatever the number of keys or columns it looks
at, and reduces before it joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.functions import clean, pct, typed
from roadledger.model import DIMENSIONS, UNKNOWN_KEY, Source


def _stack(pairs: Sequence[tuple[str, str]], label: str, value: str) -> Column:
    """stack() over (label text, column) pairs."""
    cells = ", ".join(f"'{text}', `{column}`" for text, column in pairs)
    return F.expr(f"stack({len(pairs)}, {cells}) AS ({label}, {value})")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """DQ-5, SET-1: (object_name, rows) over several tables."""
    return union_all(
        [
            frame.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("object_name"), "rows"
            )
            for name, frame in tables.items()
        ]
    )


def orphan_report(fact: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """DQ-3: rows per foreign key that point at the Unknown member."""
    counts = fact.agg(*[F.count_if(F.col(k) == UNKNOWN_KEY).alias(k) for k in keys])
    labels = [(k.removesuffix("_id"), k) for k in keys]
    return counts.select(
        F.lit(name).alias("fact"), _stack(labels, "fk", "orphans")
    )


def dangling_keys(
    fact: DataFrame, name: str, dims: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """DQ-4, DQ-8: fact rows per key whose dimension member does not exist.

    ``dims`` maps a fact column to (dimension, its key). All keys of the fact are
    counted in one pass; what meets the dimensions is one row per key value.
    """
    pairs = [(column, f"_k{i}") for i, column in enumerate(dims)]
    cast = fact.select(
        *[F.col(column).cast("string").alias(alias) for column, alias in pairs]
    )
    used = (
        cast.select(_stack(pairs, "key", "member"))
        .groupBy("key", "member")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    members = union_all(
        [
            dim.select(
                F.lit(column).alias("key"), F.col(dim_key).cast("string").alias("member")
            )
            for column, (dim, dim_key) in dims.items()
        ]
    )
    missing = used.join(members, ["key", "member"], "left_anti").select("key", "_n")
    # A zero per key, so that a clean key shows up too.
    listed = F.explode(F.array(*[F.lit(column) for column in dims])).alias("key")
    zeros = fact.sparkSession.range(1).select(listed, F.lit(0).cast("bigint").alias("_n"))
    return (
        missing.unionByName(zeros)
        .groupBy("key")
        .agg(F.sum("_n").alias("dangling"))
        .select(F.lit(name).alias("fact"), "key", "dangling")
    )


def dangling_by_column(
    fact: DataFrame, name: str, dims: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """``dangling_keys`` of a fact that is cheap to read again, such as a stored one.

    Every key is counted from its own column, in the type it has, and is text only where
    it meets its dimension, one row per key value. No row is multiplied by the number of
    keys, and a dimension that is small enough to broadcast needs no shuffle at all.
    """

    def dangling(column: str, dim: DataFrame, dim_key: str) -> DataFrame:
        used = fact.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        members = dim.select(F.col(dim_key).cast("string").alias("_member"))
        known = F.col("_key").cast("string") == F.col("_member")
        total = F.coalesce(F.sum("_n"), F.lit(0).cast("bigint"))
        return (
            used.join(members, known, "left_anti")
            .agg(total.alias("dangling"))
            .select(F.lit(name).alias("fact"), F.lit(column).alias("key"), "dangling")
        )

    return union_all([dangling(column, *parent) for column, parent in dims.items()])


def duplicate_summary(frame: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """DQ-6, DQ-9: keys that repeat and rows beyond the first of each."""
    per_key = frame.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.count_if(F.col("_n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows"),
    ).select(F.lit(name).alias("object_name"), "repeated_keys", "surplus_rows")


def blank_profile(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """DQ-7, DQ-10: rows, NULLs and blank texts per column, in one aggregate."""
    names = list(columns or frame.columns)
    kinds = dict(frame.dtypes)

    def empty(name: str) -> Column:
        if kinds[name] != "string":
            return F.lit(False)
        return F.col(name).isNotNull() & clean(F.col(name)).isNull()

    counts = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(n).isNull()).alias(f"_null_{i}") for i, n in enumerate(names)],
        *[F.count_if(empty(n)).alias(f"_blank_{i}") for i, n in enumerate(names)],
    )
    cells = ", ".join(
        f"'{n}', `_null_{i}`, `_blank_{i}`" for i, n in enumerate(names)
    )
    return counts.select(
        F.expr(f"stack({len(names)}, {cells}) AS (column_name, nulls, blanks)"), "rows"
    ).select("column_name", "rows", "nulls", "blanks")


def _per_column(
    staged: DataFrame, source: Source, name: str, broken: Mapping[str, Column]
) -> DataFrame:
    counts = staged.agg(*[F.count_if(c).alias(k) for k, c in broken.items()])
    return counts.select(
        F.lit(source.name).alias("object_name"),
        _stack([(k, k) for k in broken], "column_name", name),
    )


def uncastable(staged: DataFrame, source: Source) -> DataFrame:
    """DQ-16: texts per column that are present but do not fit the declared kind."""
    broken = {
        name: clean(F.col(name)).isNotNull() & typed(F.col(name), kind).isNull()
        for name, kind, _ in source.columns
        if kind not in ("key", "text")
    }
    return _per_column(staged, source, "uncastable", broken)


def overlong(staged: DataFrame, source: Source) -> DataFrame:
    """Texts per column longer than the declared width."""
    broken = {
        name: F.coalesce(F.length(F.col(name)) > width, F.lit(False))
        for name, _, width in source.columns
    }
    return _per_column(staged, source, "overlong", broken)


def source_profile(staged: DataFrame, source: Source) -> DataFrame:
    """DQ-10, DQ-16 per column of one source, from one scan of its staged text.

    Rows, missing texts (those of short lines), blank ones, texts that do not fit the
    declared kind, and texts over the declared width.
    """
    counts, cells = [F.count(F.lit(1)).alias("rows")], []
    for i, (name, kind, width) in enumerate(source.columns):
        text, present = F.col(name), clean(F.col(name)).isNotNull()
        fits = typed(F.col(name), kind).isNotNull() if kind not in ("key", "text") else F.lit(True)
        counts += [
            F.count_if(text.isNull()).alias(f"_null_{i}"),
            F.count_if(text.isNotNull() & ~present).alias(f"_blank_{i}"),
            F.count_if(present & ~fits).alias(f"_unfit_{i}"),
            F.count_if(F.length(text) > width).alias(f"_long_{i}"),
        ]
        cells.append(f"'{name}', _null_{i}, _blank_{i}, _unfit_{i}, _long_{i}")
    stack = (
        f"stack({len(cells)}, {', '.join(cells)})"
        " AS (column_name, nulls, blanks, uncastable, overlong)"
    )
    return (
        staged.agg(*counts)
        .select(F.lit(source.name).alias("object_name"), "rows", F.expr(stack))
        .select("object_name", "column_name", "rows", "nulls", "blanks", "uncastable", "overlong")
    )


def trip_event_violations(events: DataFrame, trips: DataFrame, finished: str) -> DataFrame:
    """DQ-11 across tables: on-time flags of events against the status of their trip.

    An event of a trip that is not ``finished`` must not have a flag, one of a finished
    trip must. Events without a known trip or trips without a status break no rule. Events
    are counted per trip before they meet the trips, so a trip is one row of the join.
    """
    per_trip = (
        events.where(F.col("trip_id").isNotNull())
        .groupBy("trip_id")
        .agg(
            F.count("on_time_flag").alias("_flagged"),
            F.count_if(F.col("on_time_flag").isNull()).alias("_open"),
        )
    )
    done = F.col("trip_status") == finished
    found = per_trip.join(trips.select("trip_id", "trip_status"), "trip_id").agg(
        F.coalesce(F.sum(F.when(~done, F.col("_flagged"))), F.lit(0)).alias("flag_of_open_trip"),
        F.coalesce(F.sum(F.when(done, F.col("_open"))), F.lit(0)).alias("finished_without_flag"),
    )
    rules = [(r, r) for r in ("flag_of_open_trip", "finished_without_flag")]
    return found.select(
        F.lit("fact_delivery").alias("object_name"), _stack(rules, "rule", "violations")
    )


def rule_violations(frame: DataFrame, name: str, rules: Mapping[str, Column]) -> DataFrame:
    """DQ-11: rows per rule for which the rule is false (unknown is not false)."""
    counts = frame.agg(*[F.count_if(~ok).alias(rule) for rule, ok in rules.items()])
    return counts.select(
        F.lit(name).alias("object_name"),
        _stack([(r, r) for r in rules], "rule", "violations"),
    )


def delivery_rules() -> dict[str, Column]:
    """Cross-field rules of a delivery event."""
    scheduled, actual = F.col("scheduled_datetime"), F.col("actual_datetime")
    return {
        "on_time_not_late": ~(F.col("on_time_flag") & (actual > scheduled)),
        "detention_not_negative": F.col("detention_minutes") >= 0,
    }


def fuel_rules(tolerance: str = "0.50") -> dict[str, Column]:
    """Cross-field rules of a fuel purchase."""
    gap = F.abs(F.col("gallons") * F.col("price_per_gallon") - F.col("total_cost"))
    return {"cost_matches_price": gap <= F.lit(tolerance).cast("decimal(12,2)")}


def trip_rules() -> dict[str, Column]:
    """Cross-field rules of a trip."""
    return {
        "completed_has_miles": (F.col("trip_status") != "Completed")
        | (F.col("actual_distance_miles") > 0),
        "idle_within_duration": F.col("idle_time_hours") <= F.col("actual_duration_hours"),
    }


def conservation(audit: DataFrame) -> DataFrame:
    """DQ-12: no row lost between the layers.

    ``audit``: (object_name, layer, rows_loaded, rows_rejected) with one name per
    object in all layers. Silver accounts for every staged row, gold for every
    accepted silver row; a star dimension holds one more, its Unknown member.
    """
    loaded = F.col("rows_loaded")
    total = loaded + F.coalesce("rows_rejected", F.lit(0))

    def of(layer: str, value: Column) -> Column:
        return F.sum(F.when(F.col("layer") == layer, value))

    unknown = F.when(F.col("object_name").isin(*DIMENSIONS), 1).otherwise(0)
    per_object = audit.groupBy("object_name").agg(
        of("bronze", total).alias("bronze"),
        of("silver", total).alias("silver"),
        of("silver", loaded).alias("silver_accepted"),
        of("gold", total - unknown).alias("gold"),
    )
    same = F.col("bronze").eqNullSafe(F.col("silver")) & F.col(
        "silver_accepted"
    ).eqNullSafe(F.col("gold"))
    return per_object.withColumn("conserved", same)


def kpi_check(actual: DataFrame, expected: Sequence[tuple[str, float, float]]) -> DataFrame:
    """DQ-13: each headline figure against its expected value and tolerance.

    ``actual`` is a one-row frame with a column per label; ``expected`` holds
    (label, value, tolerance). A missing figure fails.
    """
    cells = ", ".join(
        f"'{label}', CAST(`{label}` AS DOUBLE), CAST({value!r} AS DOUBLE),"
        f" CAST({tolerance!r} AS DOUBLE)"
        for label, value, tolerance in expected
    )
    rows = actual.select(
        F.expr(
            f"stack({len(expected)}, {cells}) AS (label, actual, expected, tolerance)"
        )
    )
    ok = F.coalesce(
        F.abs(F.col("actual") - F.col("expected")) <= F.col("tolerance"), F.lit(False)
    )
    return rows.withColumn("ok", ok)


def compare_figures(
    actual: DataFrame, expected: DataFrame, tolerances: Mapping[str, float]
) -> DataFrame:
    """DQ-13: figures against the same figures computed another way.

    Both frames have one row and a column per label of ``tolerances``. A missing
    figure fails.
    """

    def rows(frame: DataFrame, name: str) -> DataFrame:
        cells = ", ".join(f"'{x}', CAST(`{x}` AS DOUBLE)" for x in tolerances)
        return frame.select(F.expr(f"stack({len(tolerances)}, {cells}) AS (label, {name})"))

    allowed = F.create_map(*[F.lit(x) for pair in tolerances.items() for x in pair])
    both = rows(actual, "actual").join(rows(expected, "expected"), "label")
    ok = F.abs(F.col("actual") - F.col("expected")) <= F.col("tolerance")
    return both.withColumn("tolerance", allowed[F.col("label")].cast("double")).withColumn(
        "ok", F.coalesce(ok, F.lit(False))
    )


def completeness(
    frame: DataFrame, name: str, column: str, weight: str | None = None
) -> DataFrame:
    """DQ-14: rows of a left join whose looked-up column stayed empty.

    ``weight`` names a row count when the frame was reduced before the join.
    """
    times = F.col(weight) if weight else F.lit(1)
    missing = F.sum(F.when(F.col(column).isNull(), times).otherwise(0))
    return frame.agg(F.coalesce(missing, F.lit(0)).alias("missing")).select(
        F.lit(name).alias("object_name"), "missing", (F.col("missing") == 0).alias("complete")
    )


def unassigned_keys(fact: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """DQ-15: rows without a key and rows whose key has no parent, apart.

    ``fact`` holds the source keys, before the reference check.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    members = parents.select(key).distinct().withColumn("_known", F.lit(True))
    joined = per_key.join(members, key, "left")
    n = F.col("_n")
    blank = F.col(key).isNull()
    unmatched = ~blank & F.col("_known").isNull()
    total = joined.agg(
        F.sum(n).alias("rows"),
        F.sum(F.when(blank, n).otherwise(0)).alias("blank"),
        F.sum(F.when(unmatched, n).otherwise(0)).alias("unmatched"),
    )
    return total.select(
        F.lit(key).alias("key"),
        "rows",
        "blank",
        "unmatched",
        pct(F.col("blank") + F.col("unmatched"), F.col("rows")).alias("unknown_pct"),
    )
