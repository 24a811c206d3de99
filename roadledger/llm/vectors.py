"""Query blocks against row shards, for the two vector searches.

Rows go to shards and queries to blocks by a hash of their id, each of a bounded size on
average, so copies of one vector spread over all shards. A block meets every shard in a
task of its own, which returns the best rows of that shard; a window over (query, score)
with a group limit keeps the best of all. Work is rows times queries, as the task demands;
memory per task is one shard and one block.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadledger.llm.common import ship

#: (row ids, rows, query ids, queries) -> (position of query, row id, score)
Search = Callable[
    [np.ndarray, np.ndarray, np.ndarray, np.ndarray],
    tuple[np.ndarray, np.ndarray, np.ndarray],
]


def usable(vector: Column) -> Column:
    """Neither null nor empty, and no null or non-finite component."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def matrices(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length -> (ids, rows), in id order; of rows with one id the smallest vector."""
    ids = table.column("id").to_numpy()
    lists = table.column("vec").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
    sizes = np.diff(lists.offsets.to_numpy())
    found = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        rows = lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), size)
        order = np.lexsort((*rows.T[::-1], ids[at]))
        own, rows = ids[at][order], rows[order]
        first = np.r_[True, own[1:] != own[:-1]]
        found[int(size)] = (own[first], np.ascontiguousarray(rows[first]))
    return found


def sharded_search(
    vectors: DataFrame,
    search: Search,
    is_query: Column,
    score_type: str,
    k: int,
    shard_rows: int,
    block_rows: int,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of ``vectors`` (id, vec)."""
    ship(vectors.sparkSession)
    rows, queries = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = ceil(rows / shard_rows) or 1, ceil(queries / block_rows) or 1
    left = vectors.select(
        # Both sides must hash their keys alike, so they have one type.
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "id",
        "vec",
    )
    right = vectors.where(is_query).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
        "id",
        "vec",
    )
    kind = pa.float64() if score_type == "double" else pa.int64()

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and queries.num_rows:
            data, asked = matrices(rows), matrices(queries)
            for size, (query_ids, q) in asked.items():
                if size in data:
                    position, ids, scores = search(*data[size], query_ids, q)
                    out.append((query_ids[position], ids, scores))
        columns = [
            np.concatenate([x[i] for x in out]) if out else np.empty(0, dtype=np.int64)
            for i in range(3)
        ]
        return pa.table(
            {
                "query_id": pa.array(columns[0], pa.int64()),
                "vec_id": pa.array(columns[1], pa.int64()),
                "score": pa.array(columns[2], kind),
            }
        )

    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInArrow(run, f"query_id bigint, vec_id bigint, score {score_type}")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of one query: score falling, then id rising."""
    if len(scores) > k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= limit)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]
