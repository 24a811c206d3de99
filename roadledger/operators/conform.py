"""Reference resolution and keys (JOIN-1..8, WIN-2, SET-3, SNK-7).

No broadcast is hinted here except for a frame whose size is fixed by
construction. Dimension and fact parents grow with the business, so Spark
compares their size with its broadcast threshold and shuffles beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadledger.model import DIMENSIONS, UNKNOWN_KEY, UNKNOWN_SK, Dimension

# Rows without a usable key get values that match no parent and follow from the row,
# so they do not meet in one shuffle partition.
NO_MATCH = "\u001fnone-"

# Three hex digits of a digest: at most 4,096 numbering buckets.
BUCKET_DIGITS = 3


def probe(key: str, spread_by: Sequence[str]) -> Column:
    """Join key of the fact side.

    A missing or Unknown key can match no parent, yet a shuffle join would send
    all such rows to one task. They get a key that depends on the row instead.
    """
    c = F.col(key)
    own = F.xxhash64(*[F.col(x) for x in spread_by])
    nowhere = F.concat(F.lit(NO_MATCH), own.cast("string"))
    return F.when(c.isNull() | (c == UNKNOWN_KEY), nowhere).otherwise(c)


def _row_identity(fact: DataFrame, spread_by: Sequence[str] | None) -> Sequence[str]:
    # By convention the natural key leads the column list.
    return list(spread_by) if spread_by else fact.columns[:2]


def resolve_fk(
    fact: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Keep every fact row; a key the parent does not hold becomes '-1'.

    The parent is reduced to its distinct keys first, so a repeated parent key
    cannot multiply facts.
    """
    members = (
        parent.select(F.col(parent_key or key).alias("_parent_key"))
        .where(F.col("_parent_key").isNotNull())
        .distinct()
    )
    joined = fact.withColumn(
        "_probe", probe(key, _row_identity(fact, spread_by))
    ).join(members, F.col("_probe") == F.col("_parent_key"), "left")
    found = F.col("_parent_key").isNotNull()
    return joined.withColumn(
        key, F.when(found, F.col(key)).otherwise(F.lit(UNKNOWN_KEY))
    ).drop("_probe", "_parent_key")


def missing_keys(
    fact: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Keys of the fact that their parent does not hold: (key, member, rows).

    ``parents`` maps a fact column to (parent, its key). The fact is read once
    and only in its key columns; equal keys are counted before they meet the
    parents, so neither wide rows nor hot keys are shuffled.
    """
    cells = ", ".join(f"'{k}', `{k}`" for k in parents)
    used = (
        fact.select(F.expr(f"stack({len(parents)}, {cells}) AS (key, member)"))
        .where(F.col("member").isNotNull() & (F.col("member") != UNKNOWN_KEY))
        .groupBy("key", "member")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    members = reduce(
        DataFrame.unionByName,
        [
            parent.select(F.lit(k).alias("key"), F.col(parent_key).alias("member"))
            for k, (parent, parent_key) in parents.items()
        ],
    )
    return used.join(members, ["key", "member"], "left_anti")


def apply_missing(
    fact: DataFrame,
    missing: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Turn blank keys and the keys listed in ``missing`` into '-1'.

    Gives what ``resolve_fk`` gives per key. With ``missing`` stored, its size is
    known and the fact usually stays in place, whatever the size of its parents.
    """
    identity = _row_identity(fact, spread_by)
    for key in keys:
        listed = missing.where(F.col("key") == key).select(
            F.col("member").alias("_member")
        )
        lost = F.col(key).isNull() | F.col("_member").isNotNull()
        fact = (
            fact.withColumn("_probe", probe(key, identity))
            .join(listed, F.col("_probe") == F.col("_member"), "left")
            .withColumn(key, F.when(lost, F.lit(UNKNOWN_KEY)).otherwise(F.col(key)))
            .drop("_probe", "_member")
        )
    return fact


def resolve_sk(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    sk: str,
    spread_by: Sequence[str] | None = None,
    show_key: bool = False,
) -> DataFrame:
    """Replace natural ``key`` by the dimension's surrogate ``sk``.

    A key without a member gets the Unknown surrogate; the row stays. With ``show_key``
    the member's natural key follows the surrogate under the name ``key``. Taken from the
    same lookup it needs no join by ``sk``, where all Unknown rows would meet in one task.
    """
    lookup = dim.where(F.col(sk) != UNKNOWN_SK).select(
        F.col(key).alias("_member_key"), F.col(sk).alias("_member_sk")
    )
    joined = fact.withColumn(
        "_probe", probe(key, _row_identity(fact, spread_by))
    ).join(lookup, F.col("_probe") == F.col("_member_key"), "left")
    found = [F.coalesce("_member_sk", F.lit(UNKNOWN_SK).cast("bigint")).alias(sk)]
    if show_key:
        found.append(F.coalesce("_member_key", F.lit(UNKNOWN_KEY)).alias(key))
    columns = []
    for name in fact.columns:
        columns += found if name == key else [F.col(name)]
    return joined.select(*columns)


def is_known(frame: DataFrame, sk: str) -> Column:
    """Whether a key may stand for a real member.

    A surrogate does if it is positive. A natural key under the surrogate's name does
    unless it is missing or Unknown; whether it has a member shows at the lookup.
    """
    if isinstance(frame.schema[sk].dataType, T.StringType):
        return F.col(sk).isNotNull() & (F.col(sk) != UNKNOWN_KEY)
    return F.col(sk) > 0


def at_members(sums: DataFrame, dim: DataFrame, sk: str) -> DataFrame:
    """Sums per key value with the attributes of the member.

    Surrogates all have a member, Unknown included. Natural keys under the surrogate's name
    are looked up here, one row per key value, and what has no member is added up under
    Unknown; all other columns of ``sums`` must be ones that can be added.
    """
    if not isinstance(sums.schema[sk].dataType, T.StringType):
        return sums.join(dim, sk)
    spec = next(d for d in DIMENSIONS.values() if d.sk == sk)
    fixed = {sk: UNKNOWN_KEY, spec.key: UNKNOWN_KEY, **spec.unknown}
    added = [c for c in sums.columns if c != sk]
    found = F.col("_member").isNotNull()
    members = dim.withColumnRenamed(sk, "_member")
    columns = [sk, *[c for c in dim.columns if c != sk]]
    # The one row of missing keys matches nothing, wherever it goes.
    looked_up = sums.withColumnRenamed(sk, "_probe").join(
        members, F.col("_probe") == F.col("_member"), "left"
    )
    folded = looked_up.select(
        *[
            F.when(found, F.col("_member" if c == sk else c)).otherwise(F.lit(fixed.get(c))).alias(c)
            for c in columns
        ],
        *added,
    )
    return folded.groupBy(*columns).agg(*[F.sum(c).alias(c) for c in added])


def with_attributes(
    fact: DataFrame, dim: DataFrame, sk: str, columns: Sequence[str], spread_by: Sequence[str]
) -> DataFrame:
    """Every fact row with attributes of its member, from one join.

    A natural key without a member gets the Unknown member's attributes, which are
    constants; rows without a usable key are spread by the columns ``spread_by``.
    """
    if not isinstance(fact.schema[sk].dataType, T.StringType):
        return fact.join(dim.select(sk, *columns), sk)
    spec = next(d for d in DIMENSIONS.values() if d.sk == sk)
    members = dim.select(F.col(sk).alias("_member"), *[F.col(c).alias(f"_m_{c}") for c in columns])
    found = F.col("_member").isNotNull()
    return (
        fact.withColumn("_probe", probe(sk, spread_by))
        .join(members, F.col("_probe") == F.col("_member"), "left")
        .select(
            *fact.columns,
            *[
                F.when(found, F.col(f"_m_{c}")).otherwise(F.lit(spec.unknown.get(c))).alias(c)
                for c in columns
            ],
        )
    )


def surrogate_key(members: DataFrame, key: str, sk: str) -> DataFrame:
    """Number the members 1..n, densely and repeatably, without a global sort.

    Members are dealt into digest buckets of even size; each bucket is numbered
    on its own and shifted by the member count of the buckets before it. Only
    the bucket counts, at most 4,096 rows, meet in one task.
    """
    digest = F.md5(F.col(key).cast("string"))
    dealt = members.withColumn("_bucket", F.substring(digest, 1, BUCKET_DIGITS))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        )
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        dealt.withColumn("_within", within)
        .join(F.broadcast(offsets), "_bucket")
        .select(
            (F.col("_offset") + F.col("_within")).cast("bigint").alias(sk),
            *members.columns,
        )
    )


def with_unknown(members: DataFrame, dim: Dimension) -> DataFrame:
    """Add the dimension's Unknown member, surrogate and natural key -1."""
    types = dict(members.dtypes)
    fixed = {dim.sk: UNKNOWN_SK, dim.key: UNKNOWN_KEY, **dim.unknown}
    unknown = members.sparkSession.range(1).select(
        *[F.lit(fixed.get(c)).cast(types[c]).alias(c) for c in members.columns]
    )
    return unknown.unionByName(members)
