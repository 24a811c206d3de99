"""Connected components by rounds of joins and grouped minima; every round is stored.

An edge is spread into its rows by ``inline``, not by a union: each branch of a union is
planned, updated and run with stages of its own, all of which the driver holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.llm.common import stored


def _pair(a: str, b: str) -> Column:
    return F.struct(F.col(a).alias("a"), F.col(b).alias("b"))


def _stars(edges: DataFrame) -> bool:
    """Whether no end of an edge (a < b) has another edge to a smaller node.

    Then every component is a star around its smallest node, and a round moves nothing.
    """
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("b").alias("node"), F.lit(1).alias("below")),
                F.struct(F.col("a").alias("node"), F.lit(0).alias("below")),
            )
        )
    )
    nodes = ends.groupBy("node").agg(
        F.sum("below").alias("below"), F.count("*").alias("edges")
    )
    moving = (F.col("below") > 0) & (F.col("edges") > 1)
    return nodes.agg(F.count_if(moving)).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node of ``edges`` (a, b).

    Alternating star contraction: every node points its larger neighbours, then its
    smaller ones, at its least neighbour, until all edges form stars. Rounds grow with the
    logarithm of the nodes; a round moves at most two rows per edge, and the minimum of
    a node of many edges is combined before the shuffle.
    """
    current = stored(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while not _stars(current):
        both = current.select(F.inline(F.array(_pair("a", "b"), _pair("b", "a"))))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        # Each x gets its smaller neighbours: rows (x, m) with m < x.
        low = current.join(least, "a").select(F.col("b").alias("x"), "m").distinct()
        root = low.groupBy("x").agg(F.min("m").alias("r"))
        current = stored(
            low.join(root, "x")
            .select(F.inline(F.array(_pair("r", "x"), _pair("r", "m"))))
            .where("a <> b")
            .distinct(),
            "edges",
        )
    return current.select(
        F.inline(
            F.array(
                F.struct(F.col("b").alias("node"), F.col("a").alias("root")),
                F.struct(F.col("a").alias("node"), F.col("a").alias("root")),
            )
        )
    ).distinct()
