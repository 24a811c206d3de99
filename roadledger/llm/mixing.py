"""Mixing sources to target weights by entropy balancing.

The size of a document is its number of words. Every document has a rate r in [0, cap];
the rates stay as near as possible, in relative entropy with an upper bound, to one while
each source's words come to its target. Their form is an exponential tilt,

    r = cap * e / (cap - 1 + e),   e = exp(lambda_source * size / scale_source),

one dual value per source, found by Newton iterations on the convex dual. Sizes are
first counted per (source, size), so an iteration sums over distinct sizes, not over
documents. Rates then become whole copies: per source, from large sizes to small, the
rest of words that rounding leaves passes on to the next size, and the copies of one
size are dealt evenly over its documents in an order by hash. A source therefore misses its
target by at most half its smallest size, unless the cap forbids.

Targets: the sources in code-point order, null last, weigh 1, 2, 3, repeating, and share
all words; a target stops at cap times the source's words, the excess goes to the others
by weight until none is above.

Defined cases
    A null text has size 0. Documents of size 0 count for nothing and are taken once.
    A source without words has target 0. Repeated rows are documents of their own; equal
    rows may differ in copies, as a set the result is always the same. An empty table
    gives no rows. Further columns pass through ``mixed`` and are ignored by the plan;
    names that start with ``_mix`` are taken.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadledger.llm.common import WORD, ship, stored

#: A (source, size) group is dealt out in so many parts, each ordered by itself.
PARTS = 4096
TOLERANCE = 1e-7
STEPS = 60


def sized(docs: DataFrame) -> DataFrame:
    """The rows with _mix_source (sorts by code point, null last), _mix_size, _mix_part."""
    key = F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumns(
        {
            "_mix_source": F.when(
                F.col("source").isNotNull(), F.concat(F.lit("0"), F.col("source"))
            ).otherwise("1"),
            "_mix_size": F.coalesce(
                F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)
            ).cast("bigint"),
            "_mix_hash": key,
            "_mix_part": F.pmod(key, F.lit(PARTS)).cast("int"),
        }
    )


def targets(sizes: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """_mix_source, source_size, target; ``sizes`` has _mix_source, _mix_size, n.

    One row per source from here on; the windows over all of them see no more.
    """
    everything = Window.orderBy("_mix_source")
    per_source = (
        sizes.groupBy("_mix_source")
        .agg(
            F.sum(F.col("n") * F.col("_mix_size")).alias("source_size"),
            F.sum(
                F.col("n") * F.col("_mix_size").cast("double") * F.col("_mix_size")
            ).alias("squares"),
        )
        .withColumn("place", F.row_number().over(everything) - 1)
        .withColumn(
            "weight",
            F.element_at(
                F.array(*[F.lit(float(w)) for w in weights]),
                (F.col("place") % len(weights) + 1).cast("int"),
            ),
        )
        .withColumn("limit", F.col("source_size") * cap)
    )
    # Sources reach their limits in order of limit / weight; with the first j at their
    # limits the others get level_j words per unit of weight.
    order = Window.orderBy(F.col("limit") / F.col("weight"), "_mix_source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every).cast("double")
    held = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rest = F.sum("weight").over(every) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    levels = per_source.withColumn("level", (total - held) / rest).withColumn(
        "free", F.col("level") * F.col("weight") <= F.col("limit")
    )
    first_free = F.first(
        F.when(F.col("free"), F.col("level")), ignorenulls=True
    ).over(every)
    return levels.select(
        "_mix_source",
        "source_size",
        "squares",
        F.least(
            "limit", F.coalesce(first_free * F.col("weight"), F.col("limit"))
        ).alias("target"),
    )


def _rate(cap: float):
    e = F.exp(F.least(F.greatest(F.col("y"), F.lit(-500.0)), F.lit(500.0)))
    return F.lit(cap) * e / (e + (cap - 1))


def dual_values(sizes: DataFrame, wanted: DataFrame, cap: float) -> DataFrame:
    """_mix_source, scale, lam, bound ('none', 'low', 'high'): the solved dual."""
    inner = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * cap)
    state = stored(
        wanted.select(
            "_mix_source",
            "target",
            F.when(F.col("source_size") > 0, F.col("squares") / F.col("source_size"))
            .otherwise(1.0)
            .alias("scale"),
            F.when(inner, "none")
            .when(F.col("target") > 0, "high")
            .otherwise("low")
            .alias("bound"),
            F.lit(0.0).alias("lam"),
            F.lit(float("-inf")).alias("low"),
            F.lit(float("inf")).alias("high"),
            F.lit(1.0).alias("miss"),
        ),
        "dual",
    )
    for _ in range(STEPS):
        rate = _rate(cap)
        sums = (
            sizes.join(state.where("bound = 'none'"), "_mix_source")
            .withColumn("y", F.col("lam") * F.col("_mix_size") / F.col("scale"))
            .withColumn("words", F.col("n") * F.col("_mix_size").cast("double"))
            .withColumn("r", rate)
            .groupBy("_mix_source")
            .agg(
                F.sum(F.col("words") * F.col("r")).alias("got"),
                F.sum(
                    F.col("words")
                    * F.col("_mix_size")
                    / F.col("scale")
                    * F.col("r")
                    * (1 - F.col("r") / cap)
                ).alias("slope"),
            )
        )
        over = F.col("got") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("lam"))
        high = F.when(over, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - (F.col("got") - F.col("target")) / F.col("slope")
        # Outside the bracket, or where the slope vanishes: halve, or step outwards.
        middle = (
            F.when(
                (F.col("low") > float("-inf")) & (F.col("high") < float("inf")),
                (F.col("low") + F.col("high")) / 2,
            )
            .when(over, F.col("lam") * 2 - 1)
            .otherwise(F.col("lam") * 2 + 1)
        )
        moved = (
            state.join(sums, "_mix_source", "left")
            .withColumns({"low": low, "high": high})
            .withColumn("newton", newton)
            .select(
                "_mix_source",
                "target",
                "scale",
                "bound",
                F.when(F.col("got").isNull(), F.col("lam"))
                .when(
                    (F.col("newton") > F.col("low"))
                    & (F.col("newton") < F.col("high"))
                    & (F.abs(F.col("newton") - F.col("lam")) < 4),
                    F.col("newton"),
                )
                .otherwise(middle)
                .alias("lam"),
                "low",
                "high",
                F.coalesce(
                    F.abs(F.col("got") - F.col("target")) / F.col("target"), F.lit(0.0)
                ).alias("miss"),
            )
        )
        state = stored(moved, "dual")
        if (state.agg(F.max("miss")).first()[0] or 0.0) < TOLERANCE:
            break
    # Sums of doubles may differ in their last digits from run to run; nine digits do not.
    return state.select(
        "_mix_source", "scale", "bound", F.round("lam", 9).alias("lam")
    )


def _copies_per_size(group: pd.DataFrame) -> pd.DataFrame:
    """Copies for each size of one source, large sizes first, the rest carried on."""
    group = group.sort_values("_mix_size", ascending=False, ignore_index=True)
    copies, carry = [], 0.0
    for size, n, most, rate in zip(
        group["_mix_size"], group["n"], group["most"], group["r"]
    ):
        if size == 0:
            copies.append(int(n))
            continue
        wish = n * rate + carry / size
        taken = int(min(max(np.floor(wish + 0.5), 0), most))
        carry = (wish - taken) * size
        copies.append(taken)
    return pd.DataFrame(
        {
            "_mix_source": group["_mix_source"],
            "_mix_size": group["_mix_size"],
            "k": np.asarray(copies, dtype=np.int64),
        }
    )


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3
) -> DataFrame:
    """``docs`` with size, source_size, target and copies (replacing such columns)."""
    ship(docs.sparkSession)
    rows = sized(docs)
    parts = stored(
        rows.groupBy("_mix_source", "_mix_size", "_mix_part").agg(
            F.count("*").alias("n_part")
        ),
        "parts",
    )
    group = ["_mix_source", "_mix_size"]
    sizes = stored(parts.groupBy(*group).agg(F.sum("n_part").alias("n")), "sizes")
    wanted = stored(targets(sizes, weights, float(cap)), "targets")
    dual = dual_values(sizes, wanted, float(cap))
    rates = sizes.join(dual, "_mix_source").withColumn(
        "y", F.col("lam") * F.col("_mix_size") / F.col("scale")
    )
    rates = rates.select(
        *group,
        "n",
        (F.col("n") * cap).alias("most"),
        F.when(F.col("bound") == "none", _rate(float(cap)))
        .when(F.col("bound") == "high", float(cap))
        .otherwise(0.0)
        .alias("r"),
    )
    # One row per distinct size of a source meets here, however many documents it has.
    whole = rates.groupBy("_mix_source").applyInPandas(
        _copies_per_size, "_mix_source string, _mix_size bigint, k bigint"
    )
    upto = Window.partitionBy(*group).orderBy("_mix_part")
    seen = F.sum("n_part").over(upto)
    plan = (
        parts.join(sizes.join(whole, group), group)
        .withColumn("seen", seen)
        .select(
            *group,
            "_mix_part",
            F.col("n_part").alias("_mix_n"),
            (
                F.expr("(seen * k) div n") - F.expr("((seen - n_part) * k) div n")
            ).alias("_mix_k"),
        )
        .join(
            wanted.select(
                "_mix_source",
                F.col("source_size").alias("_mix_words"),
                F.col("target").alias("_mix_target"),
            ),
            "_mix_source",
        )
    )
    within = Window.partitionBy(*group, "_mix_part").orderBy("_mix_hash", "doc_id")
    kept = [
        c
        for c in docs.columns
        if c.lower() not in ("size", "source_size", "target", "copies")
    ]
    return (
        rows.join(plan, [*group, "_mix_part"])
        .withColumn("_mix_rank", F.row_number().over(within))
        .select(
            *kept,
            F.col("_mix_size").alias("size"),
            F.col("_mix_words").alias("source_size"),
            F.col("_mix_target").alias("target"),
            F.expr(
                "(_mix_rank * _mix_k) div _mix_n - ((_mix_rank - 1) * _mix_k) div _mix_n"
            ).alias("copies"),
        )
    )


def repeated(mix: DataFrame, columns: list[str]) -> DataFrame:
    """The mix written out: every document as many times as it has copies."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return (
        mix.where(F.col("copies") > 0)
        .select(*columns, times.alias("_mix_copy"))
        .select(*columns)
    )
