"""Session defaults for the batch jobs.

Sizes follow the cluster: shuffle partitions start high and adaptive execution
coalesces them, and adaptive skew handling splits a partition that holds a hot
key. No broadcast is forced on data that grows: Spark compares each side with
``autoBroadcastJoinThreshold`` and falls back to a shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even if that costs the next operator one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Columnar files unpack to several times their size; the broadcast threshold
    # is compared with the unpacked estimate.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Many thin shuffle partitions to start from; small ones are coalesced.
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "roadledger", **overrides: str) -> SparkSession:
    """Session with the defaults above; ``overrides`` use '__' for '.' in keys."""
    builder = SparkSession.builder.appName(app)
    settings = dict(DEFAULTS)
    settings.update({k.replace("__", "."): v for k, v in overrides.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
