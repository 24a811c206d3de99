"""Surrogates that outlive a build (WIN-2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadledger.operators.conform import surrogate_key
from roadledger.sources.tables import Warehouse


def new_numbers(members: DataFrame, known: DataFrame, key: str, sk: str, after: int) -> DataFrame:
    """(sk, key) for the members that ``known`` (key) lacks, numbered after ``after``.

    Dense and repeatable like ``surrogate_key``; a missing key gets no number.
    """
    unseen = (
        members.select(key)
        .where(F.col(key).isNotNull())
        .distinct()
        .join(known.select(key), key, "left_anti")
    )
    numbered = surrogate_key(unseen, key, sk)
    return numbered.select((F.col(sk) + F.lit(after)).alias(sk), key)


@dataclass(frozen=True)
class KeyMap:
    """Natural key -> surrogate, kept in the gold layer and only ever appended to.

    A member keeps its number for good, also while it is absent, so stored facts go on
    pointing at it. A run that is started again finds its numbers in the map and adds
    none. One run writes a map at a time.
    """

    warehouse: Warehouse
    name: str
    key: str
    sk: str

    @property
    def table(self) -> str:
        return f"keys_{self.name}"

    def read(self) -> DataFrame:
        schema = T.StructType(
            [T.StructField(self.sk, T.LongType()), T.StructField(self.key, T.StringType())]
        )
        if not self.warehouse.exists("gold", self.table):
            return self.warehouse.spark.createDataFrame([], schema)
        return self.warehouse.read_all("gold", self.table)

    def extend(self, members: DataFrame) -> int:
        """Number the members that are new; returns how many there were."""
        known = self.read()
        count, last = known.agg(F.count("*"), F.coalesce(F.max(self.sk), F.lit(0))).first()
        self.warehouse.append(
            new_numbers(members, known, self.key, self.sk, last), "gold", self.table
        )
        return self.read().count() - count
