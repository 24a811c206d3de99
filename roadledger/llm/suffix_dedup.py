"""Removal of repeated strings by longest-previous-factor arrays.

A suffix has an earlier (later) match of ``least`` bytes exactly if its nearest neighbour of
smaller (larger) position in suffix order, before or behind it, shares that many. So a
task needs only such suffixes side by side that agree in their first ``least`` bytes, and
each of them cut there.

1. Equal texts are one, with their number; copies need no comparison.
2. Suffixes are dealt by the least hash of the ``GRAM``-byte strings in their first
   ``least`` bytes. Neighbouring suffixes mostly share it and travel as one run: a value, a
   place, a length. Values seen once cannot repeat and stop here.
3. The texts of the others hand out their runs with the bytes they cover. A task sorts the
   suffixes of whole values, builds the arrays of previous and next smaller (and larger)
   positions, and returns the ranges whose factor reaches ``least``. Large values are taken
   in parts that keep equal suffixes together.
4. A value of more than ``HOT`` runs would not fit a task. Its suffixes become rows with a
   128-bit hash of their first ``least`` bytes; a combinable aggregate finds number and
   first place. Results are the same.
5. Ranges are merged per text and cut out. ``keep="first"`` removes what has an earlier
   match, ``keep="none"`` also what has a later one.

Defined cases
    Null texts are empty. Offsets are bytes of UTF-8; cuts may fall inside a character, so
    the rest is binary. Matches never cross documents, overlaps count, and all is judged on
    the input. Places go by doc_id (null last), text and offset. Repeated rows are documents
    of their own; with ``keep="first"`` those equal in doc_id and text share the fate of the
    first. Texts under ``least`` bytes lose nothing. An empty table gives no rows; further
    columns of any name pass through, but for ``removed`` and ``kept``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadledger.llm.bayes_join import whole_groups
from roadledger.llm.common import discard, parted, ship, spread_join, stored, tidy, written
from roadledger.llm.windows import bounded_slabs, byte_grams, repeated_values, runs

LEAST = 200
GRAM = 64
#: Runs of one value that a task takes, and suffixes that it sorts at once.
HOT = 32_768
SORTED = 40_000
#: Runs handed out in one batch.
RUNS = 2_000


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, h (128-bit hash of the text), text as bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.expr("substring(unhex(sha2(text, 256)), 1, 16)").alias("h"), "text"
    )


def distinct_texts(docs: DataFrame) -> DataFrame:
    """tid, h, copies, place (last, doc_id), text: one stored row per distinct text."""
    rows = identified(docs)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")
    several = rows.groupBy("h").agg(F.count("*").alias("copies")).where("copies > 1")
    some, alone = parted(
        rows, F.xxhash64("h"), stored(several.select("h"), "several"), F.xxhash64("h")
    )
    merged = some.groupBy("h").agg(
        F.count("*").alias("copies"), F.min(place).alias("place"), F.first("text").alias("text")
    )
    alone = alone.select("h", F.lit(1).cast("bigint").alias("copies"), place.alias("place"), "text")
    return stored(
        merged.unionByName(alone).withColumn("tid", F.monotonically_increasing_id()), "texts"
    )


def all_runs(texts: DataFrame, least: int, gram: int) -> DataFrame:
    """value, tid, first, size, weight: runs of the suffixes with ``least`` bytes.

    ``weight`` is 2 where two suffixes of one run may be equal, else 1.
    """
    parts = least - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds, skipped in bounded_slabs(batch.column(1), least - 1):
                hashes = byte_grams(data, gram)
                value, segment, first, size = runs(hashes, bounds, parts, least)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value.view(np.int64)),
                        batch.column(0).take(pa.array(rows[segment])),
                        pa.array((first + skipped).astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                        pa.array(repeated_values(hashes, value).astype(np.int32) + 1),
                    ],
                    names=["value", "tid", "first", "size", "weight"],
                )

    ship(texts.sparkSession)
    return texts.select("tid", "text").mapInArrow(
        tidy(run), "value bigint, tid bigint, first int, size int, weight int"
    )


def handed_out(wanted: DataFrame, least: int) -> DataFrame:
    """value, tid, last, doc_id, h, first, size, bytes for every run of ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            lists = batch.column("runs")
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            flat = lists.flatten()
            value, first, size = (flat.field(n).to_numpy() for n in ("value", "first", "size"))
            offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset :]
            data = memoryview(text.buffers()[2]) if text.buffers()[2] else memoryview(b"")
            begin = offsets[row].astype(np.int64) + first
            end = begin + size + least - 1
            for at in range(0, len(row), RUNS):
                part = slice(at, at + RUNS)
                own = pa.array(row[part])
                ends = zip(begin[part].tolist(), end[part].tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value[part]),
                        *(batch.column(n).take(own) for n in ("tid", "last", "doc_id", "h")),
                        pa.array(first[part]),
                        pa.array(size[part]),
                        pa.array([bytes(data[a:b]) for a, b in ends], pa.binary()),
                    ],
                    names=["value", "tid", "last", "doc_id", "h", "first", "size", "bytes"],
                )

    return wanted.select("tid", "last", "doc_id", "h", "text", "runs").mapInArrow(
        tidy(run),
        "value bigint, tid bigint, last boolean, doc_id bigint, h bigint, first int,"
        " size int, bytes binary",
    )


def nearest_smaller(place: np.ndarray, same: np.ndarray, step: int) -> np.ndarray:
    """Index of the next element in direction ``step`` of smaller place and equal ``same``.

    -1 where there is none. Chains of larger elements are followed by pointer jumping.
    """
    n = len(place)
    to = np.arange(n) + step
    at = np.arange(n)
    while len(at):
        inside = (to[at] >= 0) & (to[at] < n)
        to[at[~inside]] = -1
        at = at[inside]
        other = to[at]
        near = same[other] == same[at]
        to[at[~near]] = -1
        at, other = at[near], other[near]
        at = at[place[other] > place[at]]
        to[at] = to[to[at]]
    return to


def factors(suffixes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(has an earlier match, has a later match) for suffixes cut to one length.

    ``suffixes`` are fixed-width strings, ``place`` their distinct positions in the corpus.
    """
    order = np.argsort(suffixes, kind="stable")
    ranked, where = suffixes[order], place[order]
    # Equal cut suffixes are neighbours: their common prefix is the whole length.
    same = np.cumsum(np.r_[True, ranked[1:] != ranked[:-1]]) if len(order) else order
    found = []
    for own in (where, -where):
        before, behind = (nearest_smaller(own, same, step) for step in (-1, 1))
        flags = np.zeros(len(order), dtype=bool)
        flags[order] = (before >= 0) | (behind >= 0)
        found.append(flags)
    return found[0], found[1]


def matched_runs(rows: pa.RecordBatch, least: int, both: bool):
    """(row, first suffix, suffixes) of the ranges with a match; rows hold whole values."""
    text = rows.column("bytes")
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset :][: len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets.astype(np.int64) - offsets[0]
    size = rows.column("size").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    start = offsets[row] + step
    ids = rows.column("doc_id").fill_null(0).to_numpy()
    last, h, tid, first = (
        rows.column(n).to_numpy(zero_copy_only=False) for n in ("last", "h", "tid", "first")
    )
    order = np.lexsort((first, tid, h, ids, last))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    # Runs of one text do not overlap, so the place of a suffix follows from its run's.
    place = rank[row] * int(size.max()) + step
    windows = np.lib.stride_tricks.sliding_window_view(data, least)
    parts = -(-len(row) // SORTED)
    if parts > 1:
        part = byte_grams(data, least)[start] % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(1, parts))
        groups = np.split(order, cuts)
    else:
        groups = [np.arange(len(row))]
    flag = np.zeros(len(row), dtype=bool)
    for at in groups:
        if len(at):
            cut = windows[start[at]].view(f"S{least}").reshape(-1)
            earlier, later = factors(cut, place[at])
            flag[at] = earlier | later if both else earlier
    hit = np.flatnonzero(flag)
    new = np.r_[True, (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])]
    new = np.flatnonzero(new[: len(hit)])
    count = np.diff(np.r_[new, len(hit)])
    return row[hit[new]], step[hit[new]], count


def sorted_matches(given: DataFrame, least: int, both: bool) -> DataFrame:
    """tid, begin, end: byte ranges of the suffixes with a match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["value"]):
            at, step, count = matched_runs(rows, least, both)
            begin = rows.column("first").to_numpy().astype(np.int64)[at] + step
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("tid").take(pa.array(at)),
                    pa.array(begin),
                    pa.array(begin + count + least - 1),
                ],
                names=["tid", "begin", "end"],
            )

    return (
        given.repartition("value")
        .sortWithinPartitions("value")
        .mapInArrow(tidy(run), "tid bigint, begin bigint, end bigint")
    )


def hashed_matches(given: DataFrame, least: int, both: bool) -> DataFrame:
    """``sorted_matches`` for values of many runs: a row per suffix, no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds, _ in bounded_slabs(batch.column("bytes"), least - 1):
                size = batch.column("size").to_numpy()[rows].astype(np.int64)
                row = np.repeat(np.arange(len(rows)), size)
                step = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                at = bounds[row] + step
                own = pa.array(rows[row])
                first = batch.column("first").to_numpy()[rows][row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(byte_grams(data, least)[at].view(np.int64)),
                        pa.array(byte_grams(data, least, second=True)[at].view(np.int64)),
                        *(batch.column(n).take(own) for n in ("tid", "last", "doc_id", "h")),
                        pa.array(first + step),
                    ],
                    names=["f1", "f2", "tid", "last", "doc_id", "h", "begin"],
                )

    rows = stored(
        given.mapInArrow(
            tidy(run),
            "f1 bigint, f2 bigint, tid bigint, last boolean, doc_id bigint, h bigint,"
            " begin bigint",
        ),
        "suffixes",
    )
    place = F.struct("last", "doc_id", "h", "tid", "begin")
    several = stored(
        rows.groupBy("f1", "f2")
        .agg(F.count("*").alias("n"), F.min(place).alias("keep"))
        .where("n > 1"),
        "several",
    )
    met = spread_join(rows, several, ["f1", "f2"], "n", rows.count())
    if not both:
        met = met.where(
            (F.col("tid") != F.col("keep.tid")) | (F.col("begin") != F.col("keep.begin"))
        )
    return met.select("tid", "begin", (F.col("begin") + least).alias("end"))


def matches(texts: DataFrame, least: int, gram: int, both: bool, hot: int) -> DataFrame:
    """tid, ranges (begin, end): what repeats, as ranges that may overlap."""
    found = stored(all_runs(texts, least, gram), "runs")
    several = stored(
        found.groupBy("value").agg(F.sum("weight").alias("n")).where("n > 1"), "values"
    )
    kept = spread_join(
        found, several.withColumn("hot", F.col("n") > hot), ["value"], "n", found.count()
    )
    per_text = stored(
        kept.groupBy("tid", "hot").agg(
            F.collect_list(F.struct("value", "first", "size")).alias("runs")
        ),
        "wanted",
    )
    some, _ = parted(texts, F.xxhash64("tid"), per_text, F.xxhash64("tid"))
    some = some.select(
        "tid", "place.last", "place.doc_id", F.xxhash64("h").alias("h"), "text"
    )

    def wanted(is_hot: bool) -> DataFrame:
        own = per_text.where(F.col("hot") == is_hot).drop("hot")
        return handed_out(some.join(own, "tid"), least)

    ranges = sorted_matches(wanted(False), least, both)
    if not several.where(F.col("n") > hot).isEmpty():
        ranges = ranges.unionByName(hashed_matches(wanted(True), least, both))
    return ranges.groupBy("tid").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint ranges, in order, that cover the same bytes; touching ones become one."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
    return begin[new], np.r_[end[new[1:] - 1], end[-1]]


def cut_out(rows: DataFrame, columns: list[str], ranges: str) -> DataFrame:
    """``columns`` of the rows, ``removed`` (merged ranges) and ``kept`` (the other bytes)."""
    spans = T.ArrayType(
        T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    )
    given = rows.select(*columns, F.col(ranges).cast(spans).alias("_llm_ranges"), "_llm_bytes")
    schema = T.StructType(
        [
            *given.schema.fields[: len(columns)],
            T.StructField("removed", spans),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, texts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            removed, kept = [], []
            for spans, text in zip(lists, texts):
                whole = text.as_buffer()
                if not spans.is_valid or not len(spans.values):
                    removed.append([])
                    kept.append(whole.to_pybytes())
                    continue
                own = spans.values
                begin, end = merged(*(own.field(n).to_numpy() for n in ("begin", "end")))
                rest = zip(np.r_[0, end].tolist(), np.r_[begin, len(whole)].tolist())
                view = memoryview(whole)
                removed.append([{"begin": a, "end": b} for a, b in zip(begin.tolist(), end.tolist())])
                kept.append(b"".join([view[a:b] for a, b in rest]))
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: batch.num_columns - 2],
                    pa.array(removed, kind),
                    pa.array(kept, pa.binary()),
                ],
                names=[*batch.schema.names[: batch.num_columns - 2], "removed", "kept"],
            )

    return given.mapInArrow(tidy(run), schema)


def joined_by_text(docs: DataFrame, decided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that ``decided`` may know, the others), both with ``_llm_bytes``.

    ``decided`` is stored and has h, copies, first (the doc_id of the first copy) and
    ranges per text; the first part gets them as ``_llm_copies``, ``_llm_first`` and
    ``_llm_found``, null where the text is unknown there.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.withColumn("_llm_bytes", text).withColumn(
        "_llm_h", F.expr("substring(unhex(sha2(_llm_bytes, 256)), 1, 16)")
    )
    some, rest = parted(rows, F.xxhash64("_llm_h"), decided, F.xxhash64("h"))
    few = decided.select(
        F.col("h").alias("_llm_h"),
        F.col("first").alias("_llm_first"),
        F.col("copies").alias("_llm_copies"),
        F.col("copies").alias("_llm_weight"),
        F.col("ranges").alias("_llm_found"),
    )
    return spread_join(some, few, ["_llm_h"], "_llm_weight", docs.count(), "left"), rest


def without_repeats(
    docs: DataFrame,
    least: int = LEAST,
    keep: str = "first",
    gram: int = GRAM,
    hot: int = HOT,
) -> DataFrame:
    """``docs`` with ``removed`` (byte ranges of repeated strings) and ``kept`` (the rest).

    ``docs`` has doc_id and text; ``keep`` is "first" or "none".
    """
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    mark = written()
    gram = min(gram, least)
    texts = distinct_texts(docs)
    ranges = matches(texts, least, gram, keep == "none", hot)
    held = texts.select("tid", "h", "copies", "place", F.octet_length("text").alias("size"))
    decided = stored(
        held.join(ranges, "tid", "left")
        .where("copies > 1 OR ranges IS NOT NULL")
        .select("h", "copies", F.col("place.doc_id").alias("first"), "ranges"),
        "decided",
    )
    discard(docs.sparkSession, mark)
    columns = [c for c in docs.columns if c not in ("removed", "kept")]
    some, rest = joined_by_text(docs.select(*columns), decided)
    kind = some.schema["_llm_found"].dataType
    size = F.octet_length("_llm_bytes").cast("bigint")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("begin"), size.alias("end")))
    copy = F.col("_llm_copies") > 1
    if keep == "first":
        copy &= ~F.col("doc_id").cast("bigint").eqNullSafe(F.col("_llm_first"))
    some = some.withColumn(
        "_llm_cut", F.when(copy & (size >= least), whole).otherwise(F.col("_llm_found"))
    )
    rest = rest.withColumn("_llm_cut", F.lit(None).cast(kind))
    held = [*columns, "_llm_bytes", "_llm_cut"]
    return cut_out(some.select(*held).unionByName(rest.select(*held)), columns, "_llm_cut")
