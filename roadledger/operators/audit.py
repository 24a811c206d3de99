"""Run audit (DQ-1, DQ-2, SNK-4, SNK-6, WIN-3, RM-2).

Row counts ride along with the write as observed metrics, on the last step
before the sink, so auditing scans nothing again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadledger.operators.staging import COPIES, MALFORMED, REJECT
from roadledger.sources.tables import Warehouse

AUDIT_TABLE = "pipeline_audit"
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("audit_id", T.IntegerType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("object_name", T.StringType(), False),
        T.StructField("rows_loaded", T.LongType(), False),
        T.StructField("rows_rejected", T.LongType(), True),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("finished_at", T.TimestampType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("notes", T.StringType(), True),
    ]
)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(microsecond=0)


@dataclass
class RunAudit:
    """Collects one line per written object; a run writes a few dozen lines."""

    warehouse: Warehouse
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    lines: list[tuple] = field(default_factory=list)

    def write(
        self,
        frame: DataFrame,
        layer: str,
        table: str,
        partition_by: tuple[str, ...] = (),
    ) -> None:
        """Replace a table and note how many rows it accepted and refused."""

        def replace(observed: DataFrame) -> None:
            self.warehouse.write(observed, layer, table, partition_by)

        self._noted(frame, layer, table, replace)

    def refresh(
        self,
        frame: DataFrame,
        layer: str,
        table: str,
        partition_by: tuple[str, ...],
        detail: Mapping[str, Column] | None = None,
        note: Callable[[list[tuple] | None], None] | None = None,
    ) -> None:
        """As ``write``, but partitions that hold the same rows already are left alone.

        The counts are those of the whole frame; the note says how much was rewritten.
        ``detail`` and ``note`` as in ``Warehouse.replace_changed``.
        """
        if not self.warehouse.exists(layer, table):
            if note:
                note(None)
            return self.write(frame, layer, table, partition_by)

        def replace(observed: DataFrame) -> str:
            # The comparison reads every row once and so completes the observation.
            changed, every = self.warehouse.replace_changed(
                observed, layer, table, partition_by, detail, note
            )
            return f"{changed} of {every} partitions rewritten"

        self._noted(frame, layer, table, replace)

    def _noted(self, frame: DataFrame, layer: str, table: str, replace) -> None:
        started = _now()
        seen = Observation(f"{layer}_{table}_{len(self.lines)}")
        if REJECT in frame.columns:
            refused = F.col(REJECT).isNotNull()
        elif MALFORMED in frame.columns:
            refused = F.col(MALFORMED)
        else:
            refused = F.lit(False)
        number = F.col(COPIES) if COPIES in frame.columns else F.lit(1)
        observed = frame.observe(
            seen,
            F.sum(F.when(refused, 0).otherwise(number)).alias("loaded"),
            F.sum(F.when(refused, number).otherwise(0)).alias("rejected"),
        )
        try:
            notes = replace(observed)
        except Exception as error:
            self.note(layer, table, 0, None, started, "FAILED", str(error))
            self.flush()
            raise
        counts = seen.get
        self.note(
            layer,
            table,
            int(counts["loaded"] or 0),
            int(counts["rejected"] or 0),
            started,
            "DONE",
            notes,
        )

    def note(self, layer, table, loaded, rejected, started, status, notes=None) -> None:
        self.lines.append(
            (
                self.run_id,
                len(self.lines) + 1,
                layer,
                table,
                loaded,
                rejected,
                started,
                _now(),
                status,
                notes,
            )
        )

    def frame(self) -> DataFrame:
        return self.warehouse.spark.createDataFrame(self.lines, AUDIT_SCHEMA)

    def flush(self) -> None:
        """Append this run's lines to the audit table."""
        self.warehouse.append(self.frame().coalesce(1), "audit", AUDIT_TABLE)


def layer_audit(audit: DataFrame, layer: str, run_id: str | None = None) -> DataFrame:
    """DQ-2: objects and row counts of one layer."""
    rows = audit.where(F.col("layer") == layer)
    if run_id is not None:
        rows = rows.where(F.col("run_id") == run_id)
    return rows.select("layer", "object_name", "rows_loaded").orderBy("object_name")
