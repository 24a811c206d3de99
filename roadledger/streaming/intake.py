"""New export files as a stream, merged batch by batch (RM-1).

``merge_batches`` keeps no state: which files were taken is in its checkpoint, and a
batch merges by natural key. A replayed batch changes nothing. A row that comes
late is merged by its file's time: it replaces nothing that is newer, so the table does
not depend on how files fall into batches.

``merge_within_watermark`` is for events that are sent again but never corrected. Spark
keeps the keys of the last stretch of event time as state and drops what repeats there.
Rows older than that stretch are not merged; they go to a quarantine table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from roadledger.model import SOURCES
from roadledger.operators.history import upsert
from roadledger.operators.staging import REJECT
from roadledger.plans.silver import silver_rows
from roadledger.sources.delimited import WHOLE_LINE, stage_lines
from roadledger.sources.tables import Warehouse, shared_folder

FILE_TIME = "_file_time"
EVENT_TIME = "_event_time"
NO_EVENT_TIME = "missing event time"


def arriving_rows(
    spark: SparkSession, directory: str, source_name: str, files_per_batch: int = 1000
) -> DataFrame:
    """Typed and derived rows of the files that appear in ``directory``."""
    source = SOURCES[source_name]
    lines = (
        spark.readStream.schema("value string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", WHOLE_LINE)
        .option("quote", "")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(directory)
        .where(F.col("value").isNotNull())
        .select("value", F.col("_metadata.file_modification_time").alias(FILE_TIME))
    )
    return silver_rows(stage_lines(lines, source, keep=[FILE_TIME]), source)


def _keep_refused(
    batch: DataFrame, warehouse: Warehouse, source_name: str, batch_id: int
) -> None:
    refused = batch.where(F.col(REJECT).isNotNull()).withColumn("batch_id", F.lit(batch_id))
    table = f"refused_{SOURCES[source_name].target}"
    warehouse.replace_partitions(refused, "audit", table, ["batch_id"])


def merge_newest(
    accepted: DataFrame,
    warehouse: Warehouse,
    source_name: str,
    partition_by: dict[str, str],
    staging: str,
) -> None:
    """Merge accepted rows into the silver table; per key the newest file wins."""
    source = SOURCES[source_name]
    changes = accepted.withColumns({name: F.expr(e) for name, e in partition_by.items()})
    tie = F.xxhash64(*[c for c in changes.columns if c != FILE_TIME])
    upsert(
        warehouse,
        "silver",
        source.target,
        changes,
        source.key,
        F.struct(F.col(FILE_TIME), tie),
        list(partition_by),
        staging,
    )


def merge_batches(
    rows: DataFrame,
    warehouse: Warehouse,
    source_name: str,
    partition_by: dict[str, str],
    checkpoint: str | None = None,
    check: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> StreamingQuery:
    """Merge every batch into the silver table of the source and end when no
    file is left.

    ``partition_by`` maps a partition column to its SQL expression. ``check``
    resolves references of a batch. Refused rows are kept in the audit layer. Per key
    the newest file wins, be it stored already; its time is stored as ``FILE_TIME``.
    ``checkpoint`` is the stream's own folder, by default
    one per source under the session's checkpoint folder.
    """
    source = SOURCES[source_name]
    folder = checkpoint or f"{shared_folder(warehouse.spark)}/intake/{source_name}"
    folder = folder.rstrip("/")

    def merge(batch: DataFrame, batch_id: int) -> None:
        _keep_refused(batch, warehouse, source_name, batch_id)
        merge_newest(
            check(batch.where(F.col(REJECT).isNull()).drop(REJECT)),
            warehouse,
            source_name,
            partition_by,
            f"{folder}/merged/{batch_id}",
        )

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )


def merge_within_watermark(
    rows: DataFrame,
    warehouse: Warehouse,
    source_name: str,
    partition_by: dict[str, str],
    event_time: str,
    delay: str,
    checkpoint: str | None = None,
    check: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> StreamingQuery:
    """Merge every event once and set aside what comes too late; ends with the files.

    ``event_time`` is a SQL expression over the rows, ``delay`` an interval. The watermark
    is the latest event time of earlier batches less ``delay``. State holds the keys of
    that stretch only, so it does not grow with the table. Of a key seen again there the
    first row stays. A row under the watermark is merged by no later batch either: it goes
    to ``audit/late_<target>`` with its batch, unless the table holds its key, which makes
    it a replay. Rows without an event time are refused.

    A batch carries its rows before and behind the state, so both come from the same files.
    It is stored before it is used: a batch that runs again replaces its own partitions and
    merges what it merged before.
    """
    source = SOURCES[source_name]
    keys = list(source.key)
    folder = checkpoint or f"{shared_folder(warehouse.spark)}/intake/{source_name}"
    folder = folder.rstrip("/")
    event = F.expr(event_time).cast("timestamp")
    timed = rows.withColumn(EVENT_TIME, event).withColumn(
        REJECT,
        F.when(F.col(REJECT).isNull() & F.col(EVENT_TIME).isNull(), NO_EVENT_TIME).otherwise(
            F.col(REJECT)
        ),
    )
    fresh = (
        timed.where(F.col(REJECT).isNull())
        .withWatermark(EVENT_TIME, delay)
        .dropDuplicatesWithinWatermark(keys)
    )
    both = fresh.withColumn("_fresh", F.lit(True)).unionByName(
        timed.withColumn("_fresh", F.lit(False))
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        path = f"{folder}/batches/{batch_id}"
        batch.write.mode("overwrite").parquet(path)
        held = warehouse.spark.read.schema(batch.schema).parquet(path)
        every, fresh = held.where(~F.col("_fresh")), held.where("_fresh")
        _keep_refused(every.drop("_fresh", EVENT_TIME), warehouse, source_name, batch_id)
        merge_newest(
            check(fresh.drop(REJECT, EVENT_TIME, "_fresh")),
            warehouse,
            source_name,
            partition_by,
            f"{folder}/merged/{batch_id}",
        )
        known = warehouse.read("silver", source.target).select(*keys)
        late = (
            every.where(F.col(REJECT).isNull())
            .drop("_fresh", REJECT)
            .join(known, keys, "left_anti")
            .withColumn("batch_id", F.lit(batch_id))
        )
        warehouse.replace_partitions(late, "audit", f"late_{source.target}", ["batch_id"])

    return (
        both.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )


def late_rows(warehouse: Warehouse, source_name: str) -> DataFrame:
    """The quarantine of ``merge_within_watermark``, without rows if nothing came late."""
    target = SOURCES[source_name].target
    schema = StructType(list(warehouse.read_all("silver", target).schema.fields))
    schema = schema.add(EVENT_TIME, "timestamp").add("batch_id", "integer")
    path = warehouse.path("audit", f"late_{target}")
    return warehouse.spark.read.schema(schema).parquet(path)
