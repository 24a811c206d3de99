"""Reading, storing and null-safe helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of an Arrow batch; texts are long, and Spark's default of 10,000 is for numbers.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "2000"


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per application, as --py-files would.

    Also keeps Arrow batches small, unless the session has a number of its own.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, BATCH_ROWS)
    package = Path(__file__).resolve().parent.parent
    if getattr(context, "_roadledger_shipped", False) or not package.is_dir():
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="package-"))
    with zipfile.ZipFile(f"{folder}/{package.name}.zip", "w") as archive:
        for source in package.rglob("*.py"):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(archive.filename)
    context._roadledger_shipped = True


def let_go() -> None:
    """Give free memory of a Python worker back to the system, at the end of a task."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def tidy(run: Callable) -> Callable:
    """A function for mapInArrow that lets go of its worker's memory at the end."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            let_go()

    return tidied


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """New folder below ``spark.checkpoint.dir``, which all executors reach.

    Where the session names none (a local test), a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


#: Tables stored and not yet discarded, oldest first.
_WRITTEN: list[str] = []


def stored(frame: DataFrame, name: str, *parts: str) -> DataFrame:
    """The frame written once to the shared folder and read back: lineage ends here.

    Files are laid out by the columns ``parts``, which then come last.
    """
    path = f"{shared_folder(frame.sparkSession)}/{name}"
    frame.write.partitionBy(*parts).parquet(path)
    _WRITTEN.append(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def written() -> int:
    """A mark for ``discard``."""
    return len(_WRITTEN)


def discard(spark: SparkSession, mark: int) -> None:
    """Delete the tables stored since ``mark``, but for the last one.

    For the end of an operator whose last stored table no longer needs the others.
    """
    for path in _WRITTEN[mark:-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.delete(folder.getParent(), True)
    del _WRITTEN[mark:]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sha256_hex(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


#: Keys that a broadcast side of ``spread_join`` holds at most.
HEAVY = 1024


def spread_join(
    rows: DataFrame,
    few: DataFrame,
    keys: list[str],
    weight: str,
    total: int,
    how: str = "inner",
) -> DataFrame:
    """Join (inner or left) of ``rows`` with ``few`` (unique ``keys``) without a hot task.

    ``weight`` is a column of ``few``: how many of the ``total`` rows have that key. Of
    keys with a ``HEAVY``-th of them there are at most ``HEAVY``; these are broadcast, the
    others meet their rows in a shuffle join. ``few`` must be cheap to read twice.
    """
    hot = F.col(weight) * HEAVY > total
    few_heavy, few_light = few.where(hot).drop(weight), few.where(~hot).drop(weight)
    mark = few_heavy.select(*keys, F.lit(True).alias("_llm_heavy"))
    light = rows.join(F.broadcast(mark), keys, "left").where("_llm_heavy IS NULL")
    return rows.join(F.broadcast(few_heavy), keys).unionByName(
        light.drop("_llm_heavy").join(few_light, keys, how)
    )


#: A word of the token-size measure: a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


#: Slots of the filter below: 2 MB as bitmaps, whatever the tables hold.
SLOTS = 2**24


def parted(
    rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column
) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among the wanted ones, rows whose key surely is not).

    Keys are 64-bit hashes. The wanted ones set bits in at most ``SLOTS`` slots, so the
    broadcast side is bounded at 2 MB; only the first part then needs a shuffle join.
    With very many wanted keys that part becomes all rows, which costs a shuffle and
    nothing else. Columns of ``rows`` may have any name that does not start with _llm_.
    """
    slot = F.pmod(wanted_key, F.lit(SLOTS)).cast("bigint") + 1
    maps = (
        wanted.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("_llm_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_llm_bits"))
    )
    maps = stored(maps, "slots")
    marked = (
        rows.withColumn("_llm_slot", F.pmod(key, F.lit(SLOTS)).cast("bigint") + 1)
        .withColumn("_llm_bucket", F.bitmap_bucket_number("_llm_slot"))
        .withColumn("_llm_bit", F.bitmap_bit_position("_llm_slot"))
        .join(F.broadcast(maps), "_llm_bucket", "left")
    )
    held = F.expr(
        "_llm_bits IS NOT NULL AND shiftright(cast(conv(hex(substring(_llm_bits,"
        " cast(_llm_bit div 8 as int) + 1, 1)), 16, 10) as int),"
        " cast(_llm_bit % 8 as int)) & 1 = 1"
    )
    some = marked.where(held).select(*rows.columns)
    none = marked.where(~held).select(*rows.columns)
    return some, none
