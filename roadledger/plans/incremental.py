"""Batch loads of new and changed export files (RM-1).

Beside the stream intakes: a batch asks the ledger which files it has not taken in their
present version, reads those alone, stores their lines and merges them by natural key.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadledger.model import SOURCES
from roadledger.operators.staging import COPIES, REJECT
from roadledger.plans.silver import silver_rows
from roadledger.sources.delimited import read_lines, stage_lines
from roadledger.sources.ledger import FILE, FileLedger
from roadledger.sources.tables import Warehouse
from roadledger.streaming.intake import FILE_TIME, merge_newest

GLOB_SIGNS = re.compile(r"([\[\]{}*?\\])")


def take_new_files(
    warehouse: Warehouse,
    source_name: str,
    directory: str,
    partition_by: Mapping[str, str],
    check: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    files_per_batch: int = 10_000,
) -> list[int]:
    """Load every unseen file version of a folder; returns the files of each batch.

    Files go oldest first, at most ``files_per_batch`` at a time (that many names meet on
    the driver), until none is left. Per key the row of the newest file wins, be it stored
    already, so the table does not depend on how files fall into batches. Refused rows are
    kept in the audit layer. ``partition_by`` and ``check`` as in ``merge_batches``.

    The lines of a batch lie in the bronze layer under its number. The ledger is written
    last: a run that broke before is repeated under the same number, replaces its lines
    and merges them again, which changes nothing.
    """
    source = SOURCES[source_name]
    ledger = FileLedger(warehouse, source_name)
    _start_silver(warehouse, source_name, partition_by)
    sizes: list[int] = []
    while True:
        oldest = ledger.unseen(directory).orderBy("modified", FILE).limit(files_per_batch)
        files = oldest.collect()
        if not files:
            return sizes
        batch = ledger.next_batch()
        # Names are taken literally, not as patterns.
        paths = [GLOB_SIGNS.sub(r"\\\1", f["path"]) for f in files]
        lines = read_lines(warehouse.spark, paths).select(
            "value",
            F.col("_metadata.file_modification_time").alias(FILE_TIME),
            F.col("_metadata.file_path").alias(FILE),
        )
        stored = f"{warehouse.path('bronze', f'arrived_{source.target}')}/batch={batch}"
        staged = stage_lines(lines, source, keep=[FILE_TIME, FILE])
        staged.write.mode("overwrite").parquet(stored)
        held = warehouse.spark.read.parquet(stored)
        rows = silver_rows(held.drop(FILE), source)
        refused = rows.where(F.col(REJECT).isNotNull()).withColumn("batch", F.lit(batch))
        warehouse.replace_partitions(
            refused, "audit", f"refused_files_{source.target}", ["batch"]
        )
        merge_newest(
            check(rows.where(F.col(REJECT).isNull()).drop(REJECT)),
            warehouse,
            source_name,
            dict(partition_by),
            f"{warehouse.path('audit', f'merging_{source.target}')}/batch={batch}",
        )
        taken = warehouse.spark.createDataFrame(files, oldest.schema)
        ledger.record(taken, held, batch)
        sizes.append(len(files))


def _start_silver(
    warehouse: Warehouse, source_name: str, partition_by: Mapping[str, str]
) -> None:
    """An empty silver table to merge into, if there is none."""
    source = SOURCES[source_name]
    if warehouse.exists("silver", source.target):
        return
    none = warehouse.spark.createDataFrame([], source.staging_schema())
    rows = silver_rows(none, source).withColumns(
        {
            FILE_TIME: F.lit(None).cast("timestamp"),
            COPIES: F.lit(1).cast("bigint"),
            **{name: F.expr(e) for name, e in partition_by.items()},
        }
    )
    warehouse.write(rows, "silver", source.target, list(partition_by))
