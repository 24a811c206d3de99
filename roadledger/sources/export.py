"""Columnar JSON export of roll-ups (SNK-9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTION_DIGITS = 3


def rounded(frame: DataFrame) -> DataFrame:
    """Fractions to three digits (half to even), flags to 0/1."""
    columns = []
    for f in frame.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.bround(c.cast("double"), FRACTION_DIGITS)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return frame.select(*columns)


def _json_value(c: Column) -> Column:
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def json_rows(frame: DataFrame) -> DataFrame:
    """One JSON array per row, values in column order."""
    values = [_json_value(F.col(c)) for c in frame.columns]
    line = F.concat(F.lit("["), F.concat_ws(",", *values), F.lit("]"))
    return rounded(frame).select(line.alias("value"))


def write_columnar(frame: DataFrame, path: str) -> None:
    """Write ``<path>/cols`` with the column list and ``<path>/rows`` with the
    row arrays. Executors write their own part files; nothing is collected."""
    names = F.to_json(F.array(*[F.lit(c) for c in frame.columns]))
    header = frame.sparkSession.range(1).select(names.alias("value"))
    header.write.mode("overwrite").text(f"{path}/cols")
    json_rows(frame).write.mode("overwrite").text(f"{path}/rows")
