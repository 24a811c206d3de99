"""Delimited text exports (SRC-1..4, SRC-7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadledger.functions import typed
from roadledger.model import SOURCES, Source
from roadledger.operators.staging import MALFORMED, RAW_LINE

# A separator no export contains, so the reader hands over whole lines.
WHOLE_LINE = "\u0001\u0002\u0003"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of all files under ``path`` (one or several) without each file's first line.

    The first line goes by position, whatever it says. Files are split among
    tasks; carriage returns before the line feed and empty lines are dropped.
    """
    return (
        spark.read.schema("value string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", WHOLE_LINE)
        .option("quote", "")
        .csv(path)
        .where(F.col("value").isNotNull())
    )


def split_line(line: Column, width: int, separator: str = ",") -> Column:
    """Fields of an unquoted line; further separators stay in the last field."""
    return F.split(line, separator, width)


def stage_lines(
    lines: DataFrame,
    source: Source,
    separator: str = ",",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every line as text columns; a short line is kept whole and marked.

    ``keep`` names columns next to ``value`` that come along.
    """
    width = len(source.columns)
    parts = lines.select(
        "value", *keep, split_line(F.col("value"), width, separator).alias("_p")
    )
    short = F.size("_p") < width
    return parts.select(
        *[
            F.when(~short, F.get("_p", F.lit(i))).alias(name)
            for i, name in enumerate(source.column_names)
        ],
        *keep,
        short.alias(MALFORMED),
        F.when(short, F.col("value")).alias(RAW_LINE),
    )


def read_delimited(
    spark: SparkSession, directory: str, source_name: str, separator: str = ","
) -> DataFrame:
    """Stage ``<directory>/<source>.csv`` (a file or a folder of part files)."""
    source = SOURCES[source_name]
    path = f"{directory.rstrip('/')}/{source_name}.csv"
    return stage_lines(read_lines(spark, path), source, separator)


def read_typed(spark: SparkSession, directory: str, source_name: str) -> DataFrame:
    """Declared types straight from the text, without checks or refusals."""
    source = SOURCES[source_name]
    staged = read_delimited(spark, directory, source_name).where(~F.col(MALFORMED))
    return staged.select(
        *[typed(F.col(name), kind).alias(name) for name, kind, _ in source.columns]
    )


def source_row_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Data lines per export file of a folder, its first line not counted."""
    lines = (
        spark.read.option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .text(directory)
        .where(F.col("value") != "")
    )
    return (
        lines.groupBy(F.input_file_name().alias("file"))
        .agg((F.count(F.lit(1)) - 1).alias("rows"))
        .select(F.element_at(F.split("file", "/"), -1).alias("file"), "rows")
    )
