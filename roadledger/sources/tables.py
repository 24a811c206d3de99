"""Layered tables on shared storage (SRC-5, SNK-1..6, RM-3)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadledger.operators.staging import COPIES, REJECT, accepted_only

LAYERS = ("bronze", "silver", "gold", "audit")


@dataclass(frozen=True)
class Warehouse:
    """Parquet tables under ``root``, one folder per layer.

    ``root`` must be storage every executor reaches. A full reload overwrites a
    table; a refused row stays in the table with its reason and is hidden from
    ``read``.
    """

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def write(
        self,
        frame: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] = (),
    ) -> None:
        """Replace the table."""
        self._writer(frame, "overwrite", partition_by, "static").parquet(
            self.path(layer, table)
        )

    def exists(self, layer: str, table: str) -> bool:
        """Whether the table was ever written."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(layer, table))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files.exists(folder)

    def replace_changed(
        self,
        frame: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str],
        detail: Mapping[str, Column] | None = None,
        note: Callable[[list[tuple] | None], None] | None = None,
    ) -> tuple[int, int]:
        """Make the table equal ``frame``, rewriting only partitions that differ.

        Partitions are compared by row number and an order-free sum of row hashes. What
        meets on the driver is a line per partition, or per part of one if ``detail``
        divides them. A partition that ``frame`` no longer has, or other columns, cause a
        full replacement. Before anything is written, ``note`` gets the values of
        ``detail`` that differ, or None for all of them. Returns (partitions rewritten,
        partitions).
        """
        parts, detail = list(partition_by), dict(detail or {})
        groups = [*parts, *detail]
        new = _digests(frame, parts, detail)
        held = self.read_all(layer, table) if self.exists(layer, table) else None
        if held is None or sorted(held.dtypes) != sorted(frame.dtypes):
            if note:
                note(None)
            self.write(frame, layer, table, parts)
            count = new.select(*parts).distinct().count()
            return count, count
        old = _digests(held.select(*frame.columns), parts, detail).withColumnsRenamed(
            {"_rows": "_old_rows", "_sum": "_old_sum", **{g: f"_old_{g}" for g in groups}}
        )
        same = F.lit(True)
        for g in groups:
            same = same & F.col(g).eqNullSafe(F.col(f"_old_{g}"))
        gone = F.col("_rows").isNull()
        lines = (
            new.join(old, same, "full")
            .select(
                *[F.when(gone, F.col(f"_old_{g}")).otherwise(F.col(g)).alias(g) for g in groups],
                gone.alias("_gone"),
                F.col("_rows").eqNullSafe(F.col("_old_rows"))
                & F.col("_sum").eqNullSafe(F.col("_old_sum")),
            )
            .collect()
        )
        differing = [tuple(r[: len(groups)]) for r in lines if not r[-1]]
        if note and differing:
            note([d[len(parts) :] for d in differing])
        kept = {tuple(r[: len(parts)]) for r in lines if not r["_gone"]}
        if any(tuple(r[: len(parts)]) not in kept for r in lines):
            self.write(frame, layer, table, parts)
            return len(kept), len(kept)
        changed = {d[: len(parts)] for d in differing}
        if changed:
            wanted = F.lit(False)
            for values in changed:
                own = F.lit(True)
                for p, v in zip(parts, values):
                    own = own & F.col(p).eqNullSafe(F.lit(v))
                wanted = wanted | own
            self.replace_partitions(frame.where(wanted), layer, table, parts)
        return len(changed), len(kept)

    def append(self, frame: DataFrame, layer: str, table: str) -> None:
        frame.write.mode("append").parquet(self.path(layer, table))

    def replace_partitions(
        self, frame: DataFrame, layer: str, table: str, partition_by: Sequence[str]
    ) -> None:
        """Replace only the partitions the frame holds rows for."""
        self._writer(frame, "overwrite", partition_by, "dynamic").parquet(
            self.path(layer, table)
        )

    @staticmethod
    def _writer(frame, mode, partition_by, overwrite):
        if partition_by:
            # One writer per task and partition value would make tiny files;
            # a rebalance groups them and splits a partition that is too large.
            frame = frame.hint("rebalance", *[F.col(c) for c in partition_by])
        writer = frame.write.mode(mode).option("partitionOverwriteMode", overwrite)
        return writer.partitionBy(*partition_by) if partition_by else writer

    def read_all(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        """Accepted rows."""
        frame = self.read_all(layer, table)
        return accepted_only(frame) if REJECT in frame.columns else frame

    def rejected(self, layer: str, table: str) -> DataFrame:
        """Refused rows with reason and copies."""
        return self.read_all(layer, table).where(F.col(REJECT).isNotNull())

    def create_schemas(self) -> None:
        """Catalog schemas of the layers, for sessions that keep a catalog."""
        for layer in LAYERS:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")

    def create_table_as(
        self,
        frame: DataFrame,
        layer: str,
        table: str,
        bucket_by: Sequence[str] = (),
        buckets: int = 0,
    ) -> None:
        """Catalog table holding the frame, replaced if it exists.

        Facts bucketed alike on ``load_id`` or ``trip_id`` join each other without
        a shuffle.
        """
        writer = frame.write.mode("overwrite")
        if bucket_by:
            writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        writer.saveAsTable(f"{layer}.{table}")


def _digests(
    frame: DataFrame, parts: Sequence[str], detail: Mapping[str, Column]
) -> DataFrame:
    """Rows and sum of row hashes per partition; a null differs from any value."""
    cells = [x for c in frame.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return frame.groupBy(*parts, *[c.alias(n) for n, c in detail.items()]).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.xxhash64(*cells).cast("decimal(38,0)")).alias("_sum"),
    )


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder all executors reach, as the cluster names it.

    ``fallback`` serves sessions without the setting, such as tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, machine-local only if Spark is."""
    local = spark.sparkContext.master.startswith("local")
    top = shared_folder(spark, tempfile.mkdtemp(prefix="roadledger-") if local else None)
    return f"{top}/{purpose}/{uuid.uuid4().hex}"
