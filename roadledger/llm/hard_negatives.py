"""Hard negatives: Strassen products of integer tiles, merged into heaps of the best.

1. Rows go to shards and anchors to blocks by a hash of their id. A shard meets a block in
   a task of its own: the scores of the tile are one matrix product over 64-bit integers,
   computed by Strassen's recursion. Odd sizes are padded with zeros. Additions are exact:
   they and the products wrap modulo 2**64, and so does any error with them, so a tile is
   right as soon as its scores themselves fit, which is checked before.
2. First pass: a heap per anchor keeps its best rows of the same label. The strips of a
   tile are merged into it, the heaps of all shards by a window with a group limit.
3. Second pass: an anchor takes its positives along. A window heap per positive keeps the
   best rows of other labels whose score lies in [share * positive, positive]; heaps are
   merged as before.

Work is anchors times rows. A task holds one shard, one block and one strip of scores; what
it returns is at most the heaps of its block.

Defined cases
    Rows without id or label, and vectors that are null, empty or hold a null or non-finite
    component take no part. Of rows with one id the smallest (vector, label) counts. Ties go
    to the smaller id. Vectors of different lengths are not compared. A tile whose scores
    could leave 64 bits is multiplied with integers of any size instead; a score beyond
    +-(2**63 - 1) is given and ranked as that limit, a scaled component beyond the largest
    double counts as that. A positive of negative score has an empty window. Anchors without
    positives, positives without negatives and an empty table give no rows; further columns
    are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadledger.llm.columnar_topk import exact_scores
from roadledger.llm.common import ship, stored
from roadledger.llm.vectors import usable

#: Side under which a product is computed directly.
LEAF = 32
#: Candidates of a tile whose scores are held at once.
STRIP = 1024
LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b over 64-bit integers, by seven products of halves."""
    (m, d), n = a.shape, b.shape[1]
    if min(m, d, n) <= LEAF:
        return a @ b
    if m % 2 or d % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, d % 2)))
        b = np.pad(b, ((0, d % 2), (0, n % 2)))
        return strassen(a, b)[:m, :n]
    m, d, n = m // 2, d // 2, n // 2
    a11, a12, a21, a22 = a[:m, :d], a[:m, d:], a[m:, :d], a[m:, d:]
    b11, b12, b21, b22 = b[:d, :n], b[:d, n:], b[d:, :n], b[d:, n:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


def tile_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(anchors, rows) inner products of whole numbers, given as doubles."""
    largest = int(np.abs(anchors).max()) * int(np.abs(rows).max())
    if largest * rows.shape[1] < 2**63 and np.abs(rows).max() < 2.0**63 > np.abs(anchors).max():
        return strassen(anchors.astype(np.int64), np.ascontiguousarray(rows.astype(np.int64).T))
    return exact_scores(anchors, rows)


def best(slot, score, ident, k: int):
    """Of (slot, score, id) entries the ``k`` best of each slot, in order."""
    order = np.lexsort((ident, -score, slot))
    slot = slot[order]
    new = np.r_[True, slot[1:] != slot[:-1]] if len(slot) else np.zeros(0, dtype=bool)
    rank = np.arange(len(slot)) - np.maximum.accumulate(np.where(new, np.arange(len(slot)), 0))
    keep = rank < k
    return slot[keep], score[order][keep], ident[order][keep]


class Heaps:
    """The ``k`` best (score, id) of every slot; merging takes any parts in any order."""

    def __init__(self, k: int):
        self.k = k
        self.entries = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))

    def merge(self, *part: np.ndarray) -> None:
        both = [np.concatenate(x) for x in zip(self.entries, part)]
        self.entries = best(*both, self.k)

    def offer(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """``scores`` and ``allowed`` are (slots, rows)."""
        held = np.where(allowed, scores, LEAST)
        if held.shape[1] > self.k:
            at = held.shape[1] - self.k
            allowed = allowed & (held >= np.partition(held, at, axis=1)[:, at, None])
        slot, row = np.nonzero(allowed)
        self.merge(slot, scores[slot, row], ids[row])


def strips(count: int) -> Iterator[slice]:
    for begin in range(0, count, STRIP):
        yield slice(begin, begin + STRIP)


def vectors_of(table: pa.Table) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in table.column("vec").chunks])
    return flat.to_numpy().reshape(table.num_rows, -1)


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def tile_positives(rows: pa.Table, anchors: pa.Table, k: int):
    """Slots are anchors."""
    ids, labels, data = column(rows, "id"), column(rows, "label"), vectors_of(rows)
    own, own_label = column(anchors, "id"), column(anchors, "label")
    asked, heaps = vectors_of(anchors), Heaps(k)
    for part in strips(len(ids)):
        allowed = own_label[:, None] == labels[part]
        allowed &= own[:, None] != ids[part]
        if allowed.any():
            heaps.offer(tile_scores(asked, data[part]), ids[part], allowed)
    slot, score, ident = heaps.entries
    return own[slot], ident, score


def tile_negatives(rows: pa.Table, anchors: pa.Table, k: int, lowest: Callable):
    """Slots are pairs of an anchor and a positive."""
    ids, labels, data = column(rows, "id"), column(rows, "label"), vectors_of(rows)
    own, own_label = column(anchors, "id"), column(anchors, "label")
    lists = anchors.column("positives").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    count = lists.value_lengths().to_numpy()
    positives = lists.flatten()
    pair_id = positives.field("vec_id").to_numpy()
    high = positives.field("score").to_numpy()
    low = lowest(high)
    pair_anchor = np.repeat(np.arange(len(own)), count)
    asked, heaps = vectors_of(anchors), Heaps(k)
    for part in strips(len(ids)):
        scores = tile_scores(asked, data[part])
        other = own_label[:, None] != labels[part]
        for begin in range(0, len(high), 512):
            at = slice(begin, begin + 512)
            pair = pair_anchor[at]
            own_scores = scores[pair]
            allowed = other[pair] & (own_scores >= low[at, None])
            allowed &= own_scores <= high[at, None]
            part_heaps = Heaps(k)
            part_heaps.offer(own_scores, ids[part], allowed)
            slot, score, ident = part_heaps.entries
            heaps.merge(slot + begin, score, ident)
    slot, score, ident = heaps.entries
    return own[pair_anchor[slot]], pair_id[slot], high[slot], ident, score


def tiles(rows: DataFrame, anchors: DataFrame, blocks: int, shards: int, run, schema: str):
    """``run`` over every pair of a shard of rows and a block of anchors."""
    left = rows.select(
        # Both sides must hash their keys alike, so they have one type.
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.size("vec").alias("dims"),
        "id",
        "label",
        "vec",
    )
    right = anchors.withColumns(
        {
            "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))),
            "block": F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"),
            "dims": F.size("vec"),
        }
    )
    arrow = pa.schema([(n, pa.int64()) for n in (f.split()[0] for f in schema.split(","))])

    def one(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return arrow.empty_table()
        found = run(rows, anchors)
        return pa.table([pa.array(x, pa.int64()) for x in found], schema=arrow)

    keys = ("shard", "block", "dims")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(one, schema)


def scaled(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component, as doubles."""
    most = F.lit(sys.float_info.max)

    def whole(x: Column) -> Column:
        y = F.greatest(F.least(x * scale, most), -most)
        # From 2**52 on every double is a whole number.
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, whole)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (4, 5),
    scale: float = 256.0,
    shard_rows: int = 8192,
    block_rows: int = 512,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``; ``is_anchor`` is over
    ``vec_id``. Negatives score at least ``share`` (a fraction) of their positive.
    """
    ship(vectors.sparkSession)
    vec = F.col("embedding").cast("array<double>")
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        vec.alias("vec"),
    )
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL").where(usable(F.col("vec")))
    least = rows.groupBy("vec_id").agg(F.min(F.struct("vec", "label")).alias("row"))
    rows = stored(
        least.select(
            F.col("vec_id").alias("id"),
            F.col("row.label").alias("label"),
            scaled(F.col("row.vec"), scale).alias("vec"),
            is_anchor.alias("anchor"),
        ),
        "rows",
    )
    count, asked = rows.agg(F.count("*"), F.count_if("anchor")).first()
    shards, blocks = ceil(count / shard_rows) or 1, ceil(asked / block_rows) or 1
    anchors = rows.where("anchor").select("id", "label", "vec")
    found = tiles(
        rows,
        anchors,
        blocks,
        shards,
        lambda rows, anchors: tile_positives(rows, anchors, positives),
        "anchor_id bigint, vec_id bigint, score bigint",
    )
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), F.asc("vec_id"))
    chosen = (
        found.withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= positives)
        .groupBy("anchor_id")
        .agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    )
    above, below = share

    def lowest(score: np.ndarray) -> np.ndarray:
        """ceil(share * score) without leaving 64 bits: score - floor((1 - share) * score)."""
        whole, rest = np.divmod(score, below)
        return score - whole * (below - above) - rest * (below - above) // below

    mined = tiles(
        rows,
        stored(
            anchors.join(chosen, F.col("id") == F.col("anchor_id")).drop("anchor_id"),
            "positives",
        ),
        blocks,
        shards,
        lambda rows, anchors: tile_negatives(rows, anchors, negatives, lowest),
        "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint,"
        " negative_score bigint",
    )
    own = Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.desc("negative_score"), F.asc("negative_id")
    )
    return (
        mined.withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= negatives)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            "negative_id",
            "positive_score",
            "negative_score",
        )
    )
