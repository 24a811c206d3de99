"""Exact top-k by inner product: columnar branch and bound.

Components are integers, floor(scale * x). A shard lies in vertical layout, one row per
dimension. Partial products grow block by block of dimensions; after each block a
candidate can gain or lose at most the product of the two remaining norms
(Cauchy-Schwarz). Candidates whose best case lies under the k-th best worst case cannot
be among the k and are compacted away; the rest read the next block. Sums are exact
integers, ties are never pruned.

Defined cases
    Vectors that are null, empty or hold a null or non-finite component take no part, nor do
    rows without id; zero vectors do. Vectors with a component so large that a sum could
    leave the exact range of a double are multiplied as integers instead, without bounds. A
    score beyond +-(2**63 - 1), which no bigint holds, is given and ranked as that limit; a
    scaled component beyond the largest double counts as that. Vectors of different lengths are not compared; of rows with one id the smallest vector counts. Fewer than k
    candidates are all returned; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import sys
from math import isqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.llm.vectors import best_rows, sharded_search, usable

#: Largest component of the double path.
LARGEST = 2**20
LARGEST_SCORE = 2**63 - 1
#: Queries whose first block of partial products is computed at once.
TOGETHER = 128


def remaining(rows: np.ndarray, width: int) -> np.ndarray:
    """(blocks, rows): norm of what lies beyond each block of dimensions."""
    squares = rows**2
    tails = [
        np.sqrt(squares[:, end:].sum(axis=1))
        for end in range(width, rows.shape[1] + width, width)
    ]
    return np.stack(tails)


def search_shard(ids, rows, query_ids, queries, k: int, width: int, ratio: float = 0.8):
    """(position of query, row id, score) of the ``k`` best rows for every query."""
    upright = np.ascontiguousarray(rows.T)
    row_tail, query_tail = remaining(rows, width), remaining(queries, width)
    blocks, dims = len(row_tail), rows.shape[1]
    out = []
    for begin in range(0, len(queries), TOGETHER):
        chunk = queries[begin : begin + TOGETHER]
        first = chunk[:, :width] @ upright[:width]
        for i, q in enumerate(chunk, begin):
            at = np.flatnonzero(ids != query_ids[i])
            partial = first[i - begin][at]
            for b in range(1, blocks + 1):
                if len(at) > k:
                    slack = query_tail[b - 1, i] * row_tail[b - 1][at] + 1e-6
                    low = partial - slack
                    limit = np.partition(low, len(low) - k)[len(low) - k]
                    alive = partial + slack >= limit
                    if alive.sum() < ratio * len(at):
                        at, partial = at[alive], partial[alive]
                if b < blocks:
                    low, high = b * width, min((b + 1) * width, dims)
                    partial = partial + q[low:high] @ upright[low:high, at]
            scores = np.rint(partial).astype(np.int64)
            best = best_rows(scores, ids[at], k)
            out.append((np.full(len(best), i), ids[at][best], scores[best]))
    return tuple(np.concatenate([x[j] for x in out]) for j in range(3))


def exact_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(queries, rows) inner products of whole numbers of any size."""
    largest = float(np.abs(queries).max()) * float(np.abs(rows).max())
    if largest * rows.shape[1] < 2**62 and max(np.abs(queries).max(), np.abs(rows).max()) < 2**62:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    scores = whole(queries).dot(whole(rows).T)
    return np.clip(scores, -LARGEST_SCORE, LARGEST_SCORE).astype(np.int64)


def search_exactly(ids, rows, query_ids, queries, k: int):
    """``search_shard`` for components of any size, without pruning."""
    out = []
    for begin in range(0, len(queries), TOGETHER):
        scores = exact_scores(queries[begin : begin + TOGETHER], rows)
        for i, own in enumerate(scores, begin):
            at = np.flatnonzero(ids != query_ids[i])
            best = at[best_rows(own[at], ids[at], k)]
            out.append((np.full(len(best), i), ids[best], own[best]))
    return tuple(np.concatenate([x[j] for x in out]) for j in range(3))


def search_all(ids, rows, query_ids, queries, k: int, width: int):
    """The best rows by the double path where sums are exact there, else by integers."""
    limit = min(LARGEST, isqrt(2**53 // rows.shape[1]))
    low_rows = (np.abs(rows) <= limit).all(axis=1)
    low_queries = (np.abs(queries) <= limit).all(axis=1)
    out = [tuple(np.zeros(0, dtype=np.int64) for _ in range(3))]
    for asked, held in (
        (low_queries, low_rows),
        (low_queries, ~low_rows),
        (~low_queries, np.ones(len(rows), dtype=bool)),
    ):
        if asked.any() and held.any():
            given = (ids[held], rows[held], query_ids[asked], queries[asked], k)
            both_low = asked is low_queries and held is low_rows
            found = search_shard(*given, width) if both_low else search_exactly(*given)
            out.append((np.flatnonzero(asked)[found[0]], *found[1:]))
    return tuple(np.concatenate([x[j] for x in out]) for j in range(3))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    width: int = 8,
    shard_rows: int = 4096,
    block_rows: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of ``vectors``.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is over ``vec_id``.
    """
    vec = F.col("embedding").cast("array<double>")
    most = F.lit(sys.float_info.max)

    def scaled(x: Column) -> Column:
        y = F.greatest(F.least(x * scale, most), -most)
        # From 2**52 on every double is a whole number.
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), vec.alias("raw"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("raw"))).select(
        F.col("vec_id").alias("id"),
        F.transform("raw", scaled).alias("vec"),
        is_query.alias("q"),
    )

    def search(ids, data, query_ids, queries):
        return search_all(ids, data, query_ids, queries, k, width)

    return sharded_search(rows, search, F.col("q"), "bigint", k, shard_rows, block_rows)
