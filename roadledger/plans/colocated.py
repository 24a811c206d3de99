"""Facts stored side by side, so that they join without a shuffle (JOIN-8, JOIN-10, JOIN-11).

Narrow copies of the load, trip and delivery facts lie in the same buckets of their load.
A query over loads with their trips and events reads bucket after bucket: neither the
joins nor the sums per load move a row. The one shuffle at the writing is paid once per
refresh instead of once per query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadledger.functions import sum0
from roadledger.operators.conform import probe

LOAD = "load_key"
# Fact -> (its load key, columns that make a row its own, columns the copies carry).
COPIES = {
    "fact_load": ("load_id", ["load_id", "date_sk"], ["date_sk", "booking_type", "gross_revenue"]),
    "fact_trip": ("load_sk", ["trip_id"], ["trip_id", "actual_distance_miles"]),
    "fact_delivery": ("load_sk", ["event_id"], ["event_id", "on_time_flag", "detention_minutes"]),
}


def store_colocated(fact: DataFrame, name: str, table: str, path: str, buckets: int) -> None:
    """Write the narrow copy of a star fact as a catalog table, one file per bucket.

    Copies that shall meet take the same ``buckets``: choose them so that a bucket of the
    largest fact fits a task. A missing or Unknown load meets no other row; such rows get
    keys that follow from the row, so they are spread over all buckets.
    """
    key, own, carried = COPIES[name]
    keyed = fact.withColumn(LOAD, probe(key, own)).select(LOAD, *carried)
    (
        keyed.repartition(buckets, LOAD)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, LOAD)
        .sortBy(LOAD)
        .saveAsTable(table)
    )


def load_stories(spark: SparkSession, loads: str, trips: str, events: str) -> DataFrame:
    """Per load its trips, miles, events and on-time share, from co-located tables.

    One row per load; what belongs to no known load is left out. Sums and joins keep the
    buckets, so the plan has no exchange.
    """
    per_trip = spark.table(trips).groupBy(LOAD).agg(
        F.count(F.lit(1)).alias("trips"), sum0(F.col("actual_distance_miles")).alias("miles")
    )
    per_event = spark.table(events).groupBy(LOAD).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("on_time_flag").alias("on_time"),
        sum0(F.col("detention_minutes")).alias("detention_minutes"),
    )
    # Sorted buckets are merged as they lie; a hash or broadcast table would cost memory.
    joined = (
        spark.table(loads)
        .join(per_trip.hint("merge"), LOAD, "left")
        .join(per_event.hint("merge"), LOAD, "left")
    )
    counts = ("trips", "miles", "events", "on_time", "detention_minutes")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
