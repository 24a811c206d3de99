"""Top-k and distinct lists (SRT-1..4, AGG-22)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(
    frame: DataFrame, by: str | Column, k: int, ties: Sequence[str]
) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ``ties`` make the choice stable.

    Each task keeps its own best ``k`` rows, so nothing is sorted globally.
    """
    measure = F.col(by) if isinstance(by, str) else by
    return frame.orderBy(measure.desc(), *[F.asc(t) for t in ties]).limit(k)


def first_by(
    frame: DataFrame, keys: Sequence[str], order: Column, columns: Sequence[str]
) -> DataFrame:
    """Per key the row with the largest ``order``, as a combinable aggregate.

    Unlike a ranking window it reduces each key before the shuffle, so a key
    that holds a third of all rows never sits in one task.
    """
    best = frame.groupBy(*keys).agg(
        F.max_by(F.struct(*columns), order).alias("_best")
    )
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in columns])


def distinct_values(frame: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return frame.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
