"""Exact order statistics (AGG-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Values are summed per range of this width before any of them is ordered.
RANGE = 1024


def exact_median(frame: DataFrame, value: Column, name: str) -> DataFrame:
    """One-row frame with the exact median of ``value``.

    Equal values are counted first, counts are summed per range of values, and only
    the one or two ranges that hold the middle are opened. What one task orders is a
    row per range, then a row per distinct value of a range.
    """
    counted = (
        frame.select(value.alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy("_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_range", F.floor(F.col("_v") / RANGE))
    )
    ranges = counted.groupBy("_range").agg(F.sum("_n").alias("_n"))
    order = Window.orderBy("_range")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("_n").over(every)
    before = F.sum("_n").over(order) - F.col("_n")
    # Places of the two middle rows, from 0; one place twice for an odd number.
    low, high = F.floor((total - 1) / 2), F.floor(total / 2)
    middle = ranges.select(
        "_range", "_n", before.alias("_before"), low.alias("_low"), high.alias("_high")
    )
    middle = middle.where("_before <= _high AND _before + _n > _low").drop("_n")
    first = (
        F.col("_before")
        + F.sum("_n").over(Window.partitionBy("_range").orderBy("_v"))
        - F.col("_n")
    )
    opened = counted.join(middle, "_range").withColumn("_first", first)

    def at(place: str) -> Column:
        inside = (F.col("_first") <= F.col(place)) & (
            F.col("_first") + F.col("_n") > F.col(place)
        )
        return F.max(F.when(inside, F.col("_v"))).cast("double")

    return opened.agg(((at("_low") + at("_high")) / 2).alias(name))
