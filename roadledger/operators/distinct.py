"""Exact distinct counts that can be added up again (AGG-3, AGG-12).

Lasting surrogates are dense, so the members of a group fit bitmaps of 32,768 bits. Maps
of small groups are merged into those of larger ones without going back to the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "bucket"
MEMBERS = "members"


def bitmaps(frame: DataFrame, keys: Sequence[str | Column], sk: str) -> DataFrame:
    """Per group and bucket of 32,768 surrogates the bits of the members seen.

    Missing and Unknown surrogates are no members. A map has 4 KB; tasks combine theirs
    before the shuffle, so a group of many rows sends one map per bucket and task.
    """
    return (
        frame.where(F.col(sk) > 0)
        .groupBy(*keys, F.bitmap_bucket_number(F.col(sk)).alias(BUCKET))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(sk))).alias(MEMBERS))
    )


def merged(maps: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Maps of larger groups; ``keys`` may be expressions over the smaller ones' keys."""
    return maps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(MEMBERS).alias(MEMBERS))


def distinct_members(
    maps: DataFrame, keys: Sequence[str | Column], name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Number of different members per group; ``within`` has the group's result names.

    Without keys there is one row, 0 if there are no maps.
    """
    names = list(within) or list(keys)
    return (
        merged(maps, keys)
        .groupBy(*names)
        .agg(F.coalesce(F.sum(F.bitmap_count(MEMBERS)), F.lit(0)).alias(name))
    )
