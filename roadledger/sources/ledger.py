"""Which export files were loaded, with their rows (RM-1, SRC-7)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadledger.sources.tables import Warehouse

FILE = "file"
IDENTITY = (FILE, "size", "modified")
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField(FILE, T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("rows", T.LongType()),
        T.StructField("batch", T.LongType()),
        T.StructField("taken_at", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class FileLedger:
    """One line per file version a source was loaded from.

    A version is a path with its size and time of change: a file that was rewritten is
    another version. Lines are only ever appended, once the rows of their batch are in
    place; one run writes the ledger at a time.
    """

    warehouse: Warehouse
    source: str
    table: str = "file_ledger"

    def read(self) -> DataFrame:
        if not self.warehouse.exists("audit", self.table):
            return self.warehouse.spark.createDataFrame([], LEDGER_SCHEMA)
        lines = self.warehouse.read_all("audit", self.table)
        return lines.where(F.col("source") == self.source)

    def listed(self, directory: str) -> DataFrame:
        """Files of a folder by name, size and time; their content is not opened."""
        return (
            self.warehouse.spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", True)
            .load(directory)
            .select(
                "path",
                F.col("_metadata.file_path").alias(FILE),
                F.col("_metadata.file_size").alias("size"),
                F.col("_metadata.file_modification_time").alias("modified"),
            )
        )

    def unseen(self, directory: str) -> DataFrame:
        """Listed files of which this version was not loaded yet."""
        return self.listed(directory).join(
            self.read().select(*IDENTITY), list(IDENTITY), "left_anti"
        )

    def next_batch(self) -> int:
        return self.read().agg(F.coalesce(F.max("batch"), F.lit(-1)) + 1).first()[0]

    def record(self, files: DataFrame, rows: DataFrame, batch: int) -> None:
        """Append the lines of a batch; ``rows`` has the column ``FILE`` of its rows."""
        counted = rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows"))
        lines = files.join(counted, FILE, "left").select(
            F.lit(self.source).alias("source"),
            *IDENTITY,
            F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
            F.lit(batch).cast("bigint").alias("batch"),
            F.current_timestamp().alias("taken_at"),
        )
        self.warehouse.append(lines.coalesce(1), "audit", self.table)
