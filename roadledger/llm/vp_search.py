"""Approximate nearest neighbours: a vantage-point tree per shard.

Nearness is the largest inner product. A row x gets one more component,
sqrt(M^2 - |x|^2) with M the largest norm of its shard, a query gets 0 there; Euclidean
distance between these, d^2 = |q|^2 + M^2 - 2 q.x, is a metric and falls as the product
grows, so the triangle inequality holds. Each node keeps the ranges of distances to its
vantage point on both sides. A side is entered only if its lower bound is at most
``factor`` times the distance of the k-th best so far: factor 1 is exact search, smaller
ones prune more and may miss rows.

Defined cases
    Vectors that are null, empty, zero or hold a null or non-finite component take no part,
    nor do rows without id. Vectors of different lengths are not compared. Of rows with one
    id the smallest vector counts. Equal vectors are one point of a tree, with its k + 1
    smallest ids, which is all that ties to smaller ids can ask of it. Fewer than k
    candidates are all returned; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.llm.vectors import sharded_search, usable

#: Approximate scores differ from exact ones by rounding only; this many more than k are
#: kept in a shard until the exact scores have ordered them.
MARGIN = 12


def build(points: np.ndarray, at: np.ndarray, leaf: int, rng):
    """Leaf: positions. Node: (vantage point, inner range, outer range, inner, outer)."""
    if len(at) <= leaf:
        return at
    vantage = points[rng.choice(at)]
    distance = np.sqrt(((points[at] - vantage) ** 2).sum(axis=1))
    order = np.argsort(distance, kind="stable")
    half = len(at) // 2
    inner, outer = order[:half], order[half:]
    return (
        vantage,
        (distance[inner[0]], distance[inner[-1]]),
        (distance[outer[0]], distance[outer[-1]]),
        build(points, np.sort(at[inner]), leaf, rng),
        build(points, np.sort(at[outer]), leaf, rng),
    )


class Tree:
    """Vantage-point tree over the distinct rows of one shard, searched by query blocks."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, leaf: int, seed=0):
        order = np.lexsort((ids, *rows.T[::-1]))
        same = np.r_[False, (rows[order][1:] == rows[order][:-1]).all(axis=1)]
        starts = np.flatnonzero(~same)
        self.rows = rows[order][starts]
        self.ids = [
            own[: k + 1] for own in np.split(ids[order], starts[1:]) if len(own)
        ]
        self.first = np.asarray([own[0] for own in self.ids], dtype=np.int64)
        self.alone = np.asarray([len(own) == 1 for own in self.ids])
        norm = (self.rows**2).sum(axis=1)
        self.top = norm.max()
        lifted = np.column_stack([self.rows, np.sqrt(np.maximum(self.top - norm, 0))])
        self.k = k
        self.root = build(
            lifted, np.arange(len(lifted)), leaf, np.random.default_rng(seed)
        )

    def search(self, query_ids: np.ndarray, queries: np.ndarray, factor: float):
        """(position of query, id, exact score) of the k best of this shard."""
        keep = min(self.k + MARGIN, len(self.rows))
        self.q, self.query_ids, self.factor = queries, query_ids, factor
        self.lifted = np.column_stack([queries, np.zeros(len(queries))])
        self.base = (queries**2).sum(axis=1) + self.top
        self.score = np.full((len(queries), keep), -np.inf)
        self.point = np.full((len(queries), keep), -1, dtype=np.int64)
        self.visit(self.root, np.arange(len(queries)))
        out = []
        for i in range(len(queries)):
            points = self.point[i][self.point[i] >= 0]
            exact = np.zeros(len(points))
            for j in range(queries.shape[1]):  # one order of addition for all
                exact += queries[i, j] * self.rows[points, j]
            sizes = [len(self.ids[p]) for p in points]
            ids = np.concatenate([self.ids[p] for p in points] or [self.first[:0]])
            exact = np.repeat(exact, sizes)
            other = ids != query_ids[i]
            ids, exact = ids[other], exact[other]
            order = np.lexsort((ids, -exact))[: self.k]
            out.append((np.full(len(order), i), ids[order], exact[order]))
        return tuple(np.concatenate([x[j] for x in out]) for j in range(3))

    def limit(self, active: np.ndarray) -> np.ndarray:
        """Distance of the k-th best, infinite while there are fewer."""
        if self.score.shape[1] < self.k:
            return np.full(len(active), np.inf)
        worst = self.score[active, self.k - 1]
        return np.sqrt(np.maximum(self.base[active] - 2 * worst, 0))

    def visit(self, node, active: np.ndarray) -> None:
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            self.scan(node, active)
            return
        vantage, inner, outer, below, beyond = node
        gap = self.base[active] - 2 * (self.lifted[active, :-1] @ vantage[:-1])
        distance = np.sqrt(np.maximum(gap, 0))
        to_inner = np.maximum(np.maximum(distance - inner[1], inner[0] - distance), 0)
        to_outer = np.maximum(np.maximum(distance - outer[1], outer[0] - distance), 0)
        near = to_inner <= to_outer
        self.visit(below, active[near])
        self.visit(beyond, active[~near])
        slack = 1e-9 * (1 + distance)
        enter = near & (to_outer <= self.factor * self.limit(active) + slack)
        self.visit(beyond, active[enter])
        enter = ~near & (to_inner <= self.factor * self.limit(active) + slack)
        self.visit(below, active[enter])

    def scan(self, at: np.ndarray, active: np.ndarray) -> None:
        scores = self.q[active] @ self.rows[at].T
        own = self.alone[at] & (self.first[at] == self.query_ids[active][:, None])
        scores[own] = -np.inf
        better = scores.max(axis=1) >= self.score[active, -1]
        active, scores = active[better], scores[better]
        if not len(active):
            return
        keep = self.score.shape[1]
        every = np.hstack([self.score[active], scores])
        points = np.hstack(
            [self.point[active], np.broadcast_to(at, (len(active), len(at)))]
        )
        first = np.where(points >= 0, self.first[points], np.iinfo(np.int64).max)
        order = np.lexsort((first, -every), axis=1)[:, :keep]
        self.score[active] = np.take_along_axis(every, order, axis=1)
        chosen = np.take_along_axis(points, order, axis=1)
        self.point[active] = np.where(np.isneginf(self.score[active]), -1, chosen)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    factor: float = 0.15,
    leaf: int = 128,
    shard_rows: int = 4096,
    block_rows: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest rows of ``vectors``.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is over ``vec_id``.
    """
    vec = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), vec.alias("vec"))
    rows = rows.where(
        F.col("vec_id").isNotNull()
        & usable(F.col("vec"))
        & F.exists("vec", lambda x: x != 0)
    )

    def search(ids, data, query_ids, queries):
        return Tree(ids, data, k, leaf).search(query_ids, queries, factor)

    marked = rows.select(F.col("vec_id").alias("id"), "vec", is_query.alias("q"))
    return sharded_search(
        marked, search, F.col("q"), "double", k, shard_rows, block_rows
    )
