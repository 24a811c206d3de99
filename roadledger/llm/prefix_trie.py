"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns. Conversations become arrays of prefix keys
(two 64-bit sums over hashed (place, role, text)); their texts go no further.

1. Equal conversations merge into one ended row: smallest id, number, digest of the ids.
2. Turns after which no conversation ends and none part from each other can be stripped
   together. The other prefixes are stops, found by one combinable aggregate over the
   prefixes of distinct conversations; the root is a stop. A path learns its stops.
3. Peeling: from the largest number of stops on a path down to the root, a round merges the
   conversations that newly end at a stop with the nodes that survive from below it, by one
   grouped sum per prefix key, which discovers the nodes and adds up members, children,
   leaves and savings. It then truncates each node's path to the stop before and hands it
   on. Rounds grow with the stops on one path, not with its turns; each is stored, and
   reads only what ends in it and the nodes of the round before.
4. Turns stripped together are nodes with one child; they follow from the node below by
   sums over its path.

The digest of the ids that end at a node is the one sequential thing: ids are joined into
texts of at most 8,192 each, and a task streams those of a node through SHA-256 in order,
holding one at a time.

Defined cases
    Null roles and texts are empty. Turns go by ``turn``, null first, ties by role and text;
    repeated rows are repeated turns. Rows without conv_id take no part. A conversation is a
    single value, handled whole; one without turns ends at the root. An empty table gives no
    rows, not even a root. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.llm.common import ship, spread_join, stored
from roadledger.llm.shingles import mix

NO_IDS = hashlib.sha256(b"").hexdigest()
TURN = "array<struct<chars:int,a:bigint,b:bigint>>"
_PLACES = np.uint64(0x9E3779B97F4A7C15)


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: the turns of every conversation in order, as length and two hashes."""
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    ).where("conv_id IS NOT NULL")
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    made = F.transform(
        "t",
        lambda t: F.struct(
            F.length(t["text"]).alias("chars"),
            F.xxhash64(t["role"], t["text"]).alias("a"),
            F.xxhash64(F.lit("second"), t["text"], t["role"]).alias("b"),
        ),
    )
    return whole.select("conv_id", made.cast(TURN).alias("turns"))


def with_heads(found: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Sequences whose first ``head`` turns (at most ``most``) are those of ``base``.

    ``base`` and ``head`` are over conv_id; a base of itself gives heads to others.
    """
    found = stored(found, "sequences")
    heads = found.where(F.col("conv_id") == base).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("heads")
    )
    given = F.coalesce("heads", F.array().cast(TURN))
    own = F.slice("turns", head.cast("int") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return (
        found.withColumn("base", base)
        .join(heads, "base", "left")
        .select(
            "conv_id", F.concat(F.slice(given, F.lit(1), head.cast("int")), own).alias("turns")
        )
    )


def paths(found: DataFrame) -> DataFrame:
    """conv_id, k1, k2, cum: keys of the prefixes of 1, 2, ... turns; characters before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, a, b = (batch.column(i) for i in (1, 2, 3))
            sizes = chars.value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            begins = ends - sizes
            place = np.arange(sizes.sum(), dtype=np.int64) - np.repeat(begins, sizes)
            place = (place.astype(np.uint64) + np.uint64(1)) * _PLACES

            def sums(values: np.ndarray) -> np.ndarray:
                total = np.zeros(len(values) + 1, dtype=values.dtype)
                np.cumsum(values, out=total[1:])
                return total[1:] - np.repeat(total[begins], sizes)

            keys = [
                sums(mix(x.flatten().to_numpy().view(np.uint64) ^ place)).view(np.int64)
                for x in (a, b)
            ]
            length = sums(chars.flatten().to_numpy().astype(np.int64))
            offsets = pa.array(np.r_[0, ends].astype(np.int32))
            # One more entry per row: no characters come before the first turn.
            cum = np.zeros(len(length) + len(sizes), dtype=np.int64)
            cum[np.arange(len(length)) + np.repeat(np.arange(len(sizes)), sizes) + 1] = length
            more = pa.array((np.r_[0, ends] + np.arange(len(sizes) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.ListArray.from_arrays(offsets, pa.array(k)) for k in keys),
                    pa.ListArray.from_arrays(more, pa.array(cum)),
                ],
                names=["conv_id", "k1", "k2", "cum"],
            )

    ship(found.sparkSession)
    return found.select(
        "conv_id",
        F.col("turns.chars").alias("chars"),
        F.col("turns.a").alias("a"),
        F.col("turns.b").alias("b"),
    ).mapInArrow(
        run, "conv_id bigint, k1 array<bigint>, k2 array<bigint>, cum array<bigint>"
    )


def id_digests(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, digest: SHA-256 of the sorted decimal conv_ids of every key, comma-joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done = []
            for *key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != current:
                    if current is not None:
                        done.append((*current, state.hexdigest()))
                    current, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield made(done)
        if current is not None:
            yield made([(*current, state.hexdigest())])

    def made(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * (len(keys) + 1)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:-1]), pa.array(columns[-1], pa.string())],
            names=[*keys, "digest"],
        )

    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string"))
    return (
        rows.groupBy(*keys, F.shiftright("conv_id", 13).alias("part"))
        .agg(F.array_join(ids, ",").alias("ids"))
        .repartition(*keys)
        .sortWithinPartitions(*keys, "part")
        .select(*keys, "ids")
        .mapInArrow(run, ", ".join(f"{k} bigint" for k in keys) + ", digest string")
    )


def key_at(array: str, depth: Column) -> Column:
    """Key of the prefix of that depth; the root's is 0."""
    return F.when(depth == 0, F.lit(0).cast("bigint")).otherwise(F.get(array, depth - 1))


def ended_rows(found: DataFrame) -> DataFrame:
    """One row per distinct conversation, with its path and its stops."""
    every = stored(
        paths(found).withColumns(
            {"e1": key_at("k1", F.size("k1")), "e2": key_at("k2", F.size("k2"))}
        ),
        "paths",
    )
    ended = stored(
        every.groupBy("e1", "e2")
        .agg(
            F.min("conv_id").alias("conv"),
            F.count("*").alias("n"),
            *(F.first(c).alias(c) for c in ("k1", "k2", "cum")),
        )
        .join(id_digests(every.select("e1", "e2", "conv_id"), ["e1", "e2"]), ["e1", "e2"]),
        "ended",
    )
    depth = F.explode(F.sequence(F.lit(0), F.size("k1"))).alias("depth")
    prefixes = ended.select("e1", "e2", "conv", "k1", "k2", depth)
    at = F.col("depth")
    prefixes = prefixes.select(
        "e1",
        "e2",
        "conv",
        "depth",
        key_at("k1", at).alias("p1"),
        key_at("k2", at).alias("p2"),
        F.struct(F.get("k1", at).alias("c1"), F.get("k2", at).alias("c2")).alias("child"),
        (at == F.size("k1")).alias("ends"),
    )
    child = F.when(~F.col("ends"), F.col("child"))
    stops = stored(
        prefixes.groupBy("p1", "p2")
        .agg(
            F.min("conv").alias("least"),
            F.count("*").alias("paths"),
            F.min(child).alias("one"),
            F.max(child).alias("other"),
            F.max("ends").alias("ends"),
            F.min("depth").alias("depth"),
        )
        .where("depth = 0 OR ends OR one <> other")
        .select("p1", "p2", "least", "paths"),
        "stops",
    )
    total = ended.select(F.sum(F.size("k1") + 1)).first()[0] or 0
    known = spread_join(
        prefixes.select("e1", "e2", "depth", "p1", "p2"), stops, ["p1", "p2"], "paths", total
    )
    per_path = known.groupBy("e1", "e2").agg(
        F.sort_array(F.collect_list(F.struct("depth", "p1", "p2", "least"))).alias("stops")
    )
    return stored(
        ended.drop("k1", "k2")
        .join(per_path, ["e1", "e2"])
        .withColumn("stop", F.size("stops") - 1),
        "entries",
        "stop",
    )


def peeled(ended: DataFrame) -> list[DataFrame]:
    """Stored nodes at stops, round by round; ``top`` is the depth of the stop before."""
    most = ended.agg(F.max("stop")).first()[0]
    rounds: list[DataFrame] = []
    columns = ["p1", "p2", "conv", "n", "children", "leaves", "saved", "digest", "stops", "cum"]
    none = F.lit(0).cast("bigint")
    survivors = None
    for j in range(-1 if most is None else most, -1, -1):
        live = ended.where(F.col("stop") == j).select(
            F.col("e1").alias("p1"),
            F.col("e2").alias("p2"),
            "conv",
            "n",
            none.alias("children"),
            none.alias("leaves"),
            none.alias("saved"),
            "digest",
            "stops",
            "cum",
        )
        if survivors is not None:
            live = live.unionByName(survivors.select(*columns))
        depth = F.get("stops", F.lit(j))["depth"]
        above = F.get("stops", F.lit(j - 1)) if j else F.lit(None)
        last = F.get("cum", depth) - F.get("cum", depth - 1) if j else none
        nodes = (
            live.groupBy("p1", "p2")
            .agg(
                F.min("conv").alias("conv"),
                F.sum("n").alias("n"),
                F.sum("children").alias("children"),
                F.greatest(F.sum("leaves"), F.lit(1)).alias("leaves"),
                F.sum("saved").alias("saved"),
                F.max("digest").alias("digest"),
                F.first("stops").alias("stops"),
                F.first("cum").alias("cum"),
            )
            .withColumns(
                {
                    "saved": F.col("saved") + (F.col("n") - 1) * last,
                    "depth": depth,
                    "top": above["depth"] if j else F.lit(-1),
                    "parent": above["least"] if j else F.lit(None).cast("bigint"),
                }
            )
        )
        nodes = stored(nodes, f"nodes-{j}")
        rounds.append(nodes)
        stripped = (F.col("n") - 1) * (F.get("cum", F.col("depth") - 1) - F.get("cum", "top"))
        if j:
            survivors = nodes.withColumns(
                {
                    "p1": above["p1"],
                    "p2": above["p2"],
                    "children": F.lit(1).cast("bigint"),
                    "saved": F.col("saved") + stripped,
                    "digest": F.lit(None).cast("string"),
                    "stops": F.slice("stops", 1, j),
                    "cum": F.slice("cum", F.lit(1), F.col("top") + 1),
                }
            )
    return rounds


def nodes_of(found: DataFrame) -> DataFrame:
    """The nodes of the trie of ``found`` (conv_id, turns), one row each.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.
    """
    rounds = peeled(ended_rows(found))
    at = F.col("depth").cast("int")
    # Turns stripped together, from just below the stop before down to the node itself.
    between = F.transform(
        F.sequence(F.col("top") + 1, at),
        lambda t: F.struct(
            t.alias("depth"),
            F.when(
                t < at,
                (F.col("n") - 1)
                * (F.get("cum", F.greatest(at - 1, F.lit(0))) - F.get("cum", t - 1)),
            )
            .otherwise(F.lit(0))
            .alias("more"),
        ),
    )
    out = None
    for nodes in rounds:
        out = nodes if out is None else out.unionByName(nodes)
    if out is None:
        return found.sparkSession.createDataFrame(
            [],
            "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint,"
            " n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
        )
    itself = F.col("t.depth") == F.col("below")
    return out.select(
        "conv",
        "top",
        "parent",
        "n",
        "children",
        "leaves",
        "saved",
        "digest",
        at.alias("below"),
        F.explode(between).alias("t"),
    ).select(
        F.col("conv").alias("conv_id"),
        F.col("t.depth").cast("bigint").alias("depth"),
        F.when(F.col("t.depth") - 1 == F.col("top"), F.col("parent"))
        .otherwise(F.col("conv"))
        .alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(itself, F.col("children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + F.col("t.more")).alias("saved_tokens"),
        F.when(itself, F.col("digest")).alias("digest"),
    ).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("digest", F.lit(NO_IDS)).alias("ends_sha256"),
    )
