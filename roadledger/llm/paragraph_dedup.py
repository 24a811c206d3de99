"""Removal of paragraphs that repeat across the documents of a corpus.

Paragraphs are of two kinds. Lines of at least ``LEAST_WORDS`` words repeat if they are
alike (Jaccard similarity of word shingles); any ``LEAST_WORDS`` words in a row, wherever
in a line or over lines they begin, repeat if they are equal. Both compare lower-case words.

1. Equal texts are one, with their number; later documents of the same text repeat whole.
2. Lines: those of the same words are one class, found by grouping. Classes have MinHash
   values in ``BANDS`` bands of ``ROWS``, which give buckets; a pair of similarity 0.8 shares
   no bucket with probability 3e-5. Exact shingle sets are fetched for the classes of shared
   buckets alone. All classes of a bucket are compared inside tasks, by blocks as in op5: a
   bound on the exact similarity drops pairs that cannot reach the threshold, and a bucket
   gives the edges that connect the others, fewer than it has classes. The classes of a
   component of those edges meet once more and are verified exactly. Verified links form
   components; lines outside the first document of their component repeat.
3. Word windows: one band of one MinHash value, the least of a window's shingle hashes,
   which equal windows share. Neighbouring windows mostly share it too and are one run.
   Buckets with runs of several texts get the words of their runs, and windows are compared
   exactly there; those outside the first document that has them repeat. Buckets of more
   than ``HOT`` runs become rows of windows with a 128-bit hash, aggregated by it.
4. The word ranges of both are merged per text and cut out: from the first word of a range to
   the next word that stays.

Documents are in order of doc_id (null last) and text. What repeats inside one document
only stays. A passage with edits that is no line of its own is found as far as it has
``LEAST_WORDS`` equal words in a row.

Defined cases
    Null texts stay null, empty ones empty. A text may become empty. Rows equal in doc_id and
    text are one document: they lose and keep the same words. An empty table gives no rows;
    further columns pass through ``cleaned``, but for ``removed``, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadledger.llm.bayes_join import (
    BLOCK,
    BLOCK_SHINGLES,
    GROUP,
    group_numbers,
    in_blocks,
    shared_shingles,
    whole_groups,
)
from roadledger.llm.common import discard, parted, ship, spread_join, stored, tidy, written
from roadledger.llm.components import components
from roadledger.llm.shingles import (
    WIDTH,
    Segments,
    chains,
    text_slabs,
    word_edges,
    words_of_slab,
)
from roadledger.llm.suffix_dedup import HOT, RUNS, distinct_texts, joined_by_text, merged
from roadledger.llm.windows import byte_grams, runs

THRESHOLD = 0.8
LEAST_WORDS = 50
ROWS, BANDS = 3, 15
#: Cells of the counts by which sets are compared; a power of two.
BINS = 64


def lowered(texts: DataFrame) -> DataFrame:
    """tid, last, doc_id, h, text in lower case, of distinct texts."""
    return texts.select(
        "tid",
        "place.last",
        "place.doc_id",
        F.xxhash64("h").alias("h"),
        F.lower(F.col("text").cast("string")).alias("text"),
    )


def long_lines(texts: DataFrame, least_words: int) -> DataFrame:
    """tid, first, words, pid, bands: lines of at least ``least_words`` words.

    ``first`` is the number of the text's words before the line.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, _, data, bounds in text_slabs(batch.column(1)):
                feeds = np.flatnonzero(data == 10) + 1
                cuts = np.unique(np.concatenate([bounds, feeds]))
                own = Segments(data, cuts)
                row = np.searchsorted(bounds, cuts[:-1], "right") - 1
                before = np.cumsum(own.words) - own.words
                before -= before[np.searchsorted(row, row)]
                some = np.flatnonzero(own.words >= least_words)
                keys = np.column_stack([k[some] for k in own.keys]).astype(">u8").tobytes()
                bands = band_keys(own.minhash(ROWS * BANDS)[some]).reshape(-1)
                offsets = np.arange(len(some) + 1, dtype=np.int32) * BANDS
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row[some] + begin)),
                        pa.array(before[some].astype(np.int32)),
                        pa.array(own.words[some].astype(np.int32)),
                        pa.array([keys[16 * i : 16 * i + 16] for i in range(len(some))], pa.binary()),
                        pa.ListArray.from_arrays(offsets, bands),
                    ],
                    names=["tid", "first", "words", "pid", "bands"],
                )

    ship(texts.sparkSession)
    return texts.select("tid", "text").mapInArrow(
        tidy(run), "tid bigint, first int, words int, pid binary, bands array<bigint>"
    )


def band_keys(minima: np.ndarray) -> np.ndarray:
    """(paragraphs, BANDS) 64-bit keys of the bands."""
    values = minima.reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :]
    for r in range(ROWS):
        key = (key ^ values[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def shared_buckets(classes: DataFrame) -> DataFrame:
    """key, rid, n: every class in every bucket that holds n >= 2 classes."""
    rows = classes.select(F.col("pid").alias("rid"), F.explode("bands").alias("key"))
    several = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(several, "key")


def histograms(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(sets, BINS) counts of shingles by their low bits, at most 255."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    cell = owner * BINS + (values[offsets[0] : offsets[-1]] & (BINS - 1))
    counts = np.bincount(cell, minlength=(len(offsets) - 1) * BINS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(-1, BINS)


def may_reach(
    bins: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float
) -> np.ndarray:
    """False where the sets i and j cannot reach the threshold.

    Sets differ in at least as many shingles as their counts differ, and in at most
    (1 - threshold) / (1 + threshold) of the sum of their sizes if they reach it.
    """
    apart = np.abs(bins[i].astype(np.int16) - bins[j]).sum(axis=1)
    apart = np.maximum(apart, np.abs(sizes[i] - sizes[j]))
    return apart <= (sizes[i] + sizes[j]) * (1 - threshold) / (1 + threshold) + 1e-6


def connecting(group, own, split, linked) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (i < j) of one group that connect what ``linked`` (i, j) accepts.

    Rows and ``split`` are those of ``close_pairs``. Every pair that no earlier ones
    connect is asked, so the result has fewer pairs than rows and the same components.
    """
    count = len(group)
    new = np.r_[True, group[1:] != group[:-1]]
    ends = np.r_[np.flatnonzero(new)[1:], count]
    room = ends[np.cumsum(new) - 1] - np.arange(count)  # rows from here to the end
    parent = list(range(count))
    label = np.arange(count)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = [], []
    at = np.arange(count)
    for gap in range(1, int(room.max(initial=1))):
        at = at[room[at] > gap]
        i, j = at, at + gap
        meet = (~split[i] | (own[i] != own[j])) & (label[i] != label[j])
        i, j = i[meet], j[meet]
        if not len(i):
            continue
        good = linked(i, j)
        for x, y in zip(i[good].tolist(), j[good].tolist()):
            a, b = find(x), find(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(x)
                right.append(y)
        if good.any():
            label = np.array(parent)
            while (label != label[label]).any():
                label = label[label]
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def sketches(sets: DataFrame) -> DataFrame:
    """rid, size, bins: what ``may_reach`` needs of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            raw = histograms(lists.values.to_numpy(), offsets).tobytes()
            bins = [raw[BINS * i : BINS * i + BINS] for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(offsets)),
                    pa.array(bins, pa.binary()),
                ],
                names=["rid", "size", "bins"],
            )

    return sets.select("rid", "shingles").mapInArrow(
        tidy(run), "rid binary, size bigint, bins binary"
    )


def candidate_edges(buckets: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """a, b: pairs that connect the classes of a bucket that may reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, GROUP):
            low, high, own, sizes = (
                rows.column(n).to_numpy() for n in ("low", "high", "own", "size")
            )
            bins = np.frombuffer(b"".join(rows.column("bins").to_pylist()), np.uint8)
            bins = bins.reshape(-1, BINS)
            i, j = connecting(
                group_numbers(rows, GROUP),
                own,
                low != high,
                lambda i, j: may_reach(bins, sizes, i, j, threshold),
            )
            rid = rows.column("rid")
            yield pa.RecordBatch.from_arrays(
                [rid.take(pa.array(i)), rid.take(pa.array(j))], names=["a", "b"]
            )

    rows = buckets.join(sketches(sets), "rid")
    return in_blocks(rows, F.ceil(F.col("n") / BLOCK)).mapInArrow(
        tidy(run), "a binary, b binary"
    )


def verified_edges(members: DataFrame, threshold: float) -> DataFrame:
    """a, b: pairs of exact similarity that connect all such pairs of a component.

    ``members`` has rid, shingles, and key, n, total: its component of candidates with
    the number of classes and of shingles there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, GROUP):
            low, high, own = (rows.column(n).to_numpy() for n in ("low", "high", "own"))
            sets = rows.column("shingles")
            offsets = sets.offsets.to_numpy().astype(np.int64)
            values, sizes = sets.values.to_numpy(), np.diff(offsets)
            bins = histograms(values, offsets)

            def linked(i, j):
                good = may_reach(bins, sizes, i, j, threshold)
                some = np.flatnonzero(good)
                i, j = i[some], j[some]
                both = shared_shingles(values, offsets, i, j)
                good[some] = both / (sizes[i] + sizes[j] - both) >= threshold
                return good

            i, j = connecting(group_numbers(rows, GROUP), own, low != high, linked)
            rid = rows.column("rid")
            yield pa.RecordBatch.from_arrays(
                [rid.take(pa.array(i)), rid.take(pa.array(j))], names=["a", "b"]
            )

    blocks = F.greatest(
        F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)
    )
    return in_blocks(members, blocks).mapInArrow(tidy(run), "a binary, b binary")


def line_sets(texts: DataFrame) -> DataFrame:
    """rid, shingles: sets of the lines asked for in ``wanted`` (first, words, rid).

    Lines are cut out and shingled in one worker, which is one worker less per task than
    two functions one behind the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                begin, end = word_edges(data, np.array([0, len(data)]))
                own = [
                    data[begin[w["first"]] : end[w["first"] + w["words"] - 1]] for w in wanted
                ]
                bounds = np.cumsum([0, *(len(x) for x in own)])
                found = Segments(np.concatenate(own), bounds)
                sets = [found.set_of(i) for i in range(len(own))]
                offsets = np.cumsum([0, *(len(x) for x in sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w["rid"] for w in wanted], pa.binary()),
                        pa.ListArray.from_arrays(offsets, np.concatenate(sets)),
                    ],
                    names=["rid", "shingles"],
                )

    return texts.select("text", "wanted").mapInArrow(
        tidy(run), "rid binary, shingles array<bigint>"
    )


def alike_lines(texts: DataFrame, threshold: float, least_words: int) -> DataFrame:
    """tid, begin, end: word ranges of lines that are like one of an earlier document."""
    lines = stored(long_lines(texts, least_words), "lines")
    places = lines.join(texts.select("tid", "last", "doc_id", "h"), "tid")
    place = F.struct("last", "doc_id", "h", "tid", "first", "words")
    classes = stored(
        places.groupBy("pid").agg(
            F.min(place).alias("place"),
            F.count("*").alias("n"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    buckets = stored(shared_buckets(classes), "buckets")
    where = stored(
        classes.join(buckets.select(F.col("rid").alias("pid")).distinct(), "pid")
        .groupBy("place.tid")
        .agg(
            F.collect_list(
                F.struct("place.first", "place.words", F.col("pid").alias("rid"))
            ).alias("wanted")
        ),
        "needed",
    )
    some, _ = parted(
        texts.select("tid", "text"), F.xxhash64("tid"), where, F.xxhash64("tid")
    )
    sets = stored(line_sets(some.join(where, "tid")), "sets")
    possible = components(candidate_edges(buckets, sets, threshold))
    members = stored(
        sets.join(possible.withColumnRenamed("node", "rid"), "rid").select(
            "rid", "shingles", F.xxhash64("root").alias("key")
        ),
        "members",
    )
    sizes = members.groupBy("key").agg(
        F.count("*").alias("n"), F.sum(F.size("shingles")).alias("total")
    )
    links = verified_edges(members.join(sizes, "key"), threshold)
    roots = components(links).withColumnRenamed("node", "pid")
    linked = classes.select("pid", "place", "n").join(roots, "pid")
    keepers = linked.groupBy("root").agg(F.min("place").alias("keep"))
    # Equal lines repeat as word windows; only likeness adds to them.
    decided = stored(
        linked.join(keepers, "root").select("pid", "n", F.col("keep.tid").alias("keep")),
        "decided-lines",
    )
    found = spread_join(lines.drop("bands"), decided, ["pid"], "n", lines.count())
    return found.where("tid <> keep").select(
        "tid",
        F.col("first").cast("bigint").alias("begin"),
        (F.col("first") + F.col("words")).cast("bigint").alias("end"),
    )


def word_runs(texts: DataFrame, least_words: int) -> DataFrame:
    """value, tid, first, size: runs of word windows with one least shingle hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, _, data, bounds in text_slabs(batch.column(1)):
                words, at = words_of_slab(data, bounds)
                value, segment, first, size = runs(
                    chains(words), at, least_words - WIDTH + 1, least_words
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value.view(np.int64)),
                        batch.column(0).take(pa.array(segment + begin)),
                        pa.array(first.astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                    ],
                    names=["value", "tid", "first", "size"],
                )

    ship(texts.sparkSession)
    return texts.select("tid", "text").mapInArrow(
        tidy(run), "value bigint, tid bigint, first int, size int"
    )


def handed_words(wanted: DataFrame, least_words: int) -> DataFrame:
    """value, tid, last, doc_id, h, first, size, words (4 bytes each) for every run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, bounds in text_slabs(batch.column("text")):
                rows = batch.slice(start, stop - start)
                words, at = words_of_slab(data, bounds)
                packed = memoryview((words >> np.uint64(32)).astype(np.uint32)).cast("B")
                lists = rows.column("runs")
                row = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy())
                flat = lists.flatten()
                value, first, size = (flat.field(n).to_numpy() for n in ("value", "first", "size"))
                begin = (at[row] + first) * 4
                end = begin + (size.astype(np.int64) + least_words - 1) * 4
                for k in range(0, len(row), RUNS):
                    part = slice(k, k + RUNS)
                    own = pa.array(row[part])
                    ends = zip(begin[part].tolist(), end[part].tolist())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(value[part]),
                            *(rows.column(n).take(own) for n in ("tid", "last", "doc_id", "h")),
                            pa.array(first[part]),
                            pa.array(size[part]),
                            pa.array([bytes(packed[a:b]) for a, b in ends], pa.binary()),
                        ],
                        names=["value", "tid", "last", "doc_id", "h", "first", "size", "words"],
                    )

    return wanted.select("tid", "last", "doc_id", "h", "text", "runs").mapInArrow(
        tidy(run),
        "value bigint, tid bigint, last boolean, doc_id bigint, h bigint, first int,"
        " size int, words binary",
    )


def spread_windows(rows: pa.RecordBatch):
    """(words, row, number in the run, first word) of every window of the rows' runs."""
    column = rows.column("words")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    words = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint32)
    begin = (offsets.astype(np.int64) - offsets[0]) // 4
    size = rows.column("size").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    return words, row, step, begin[row] + step


def compared_windows(given: DataFrame, least_words: int) -> DataFrame:
    """tid, begin, end: word ranges of windows that an earlier document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["value"]):
            words, row, step, start = spread_windows(rows)
            ids = rows.column("doc_id").fill_null(0).to_numpy()
            last, h, tid, first = (
                rows.column(n).to_numpy(zero_copy_only=False) for n in ("last", "h", "tid", "first")
            )
            order = np.lexsort((tid, h, ids, last))
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.cumsum(np.r_[0, tid[order][1:] != tid[order][:-1]])
            place = rank[row]
            window = byte_grams(words, least_words)[start]
            order = np.lexsort((place, window))
            new = np.flatnonzero(np.r_[True, window[order][1:] != window[order][:-1]])
            least = np.repeat(place[order][new], np.diff(np.r_[new, len(order)]))
            flag = np.zeros(len(row), dtype=bool)
            flag[order] = place[order] > least
            hit = np.flatnonzero(flag)
            new = np.r_[True, (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])]
            new = np.flatnonzero(new[: len(hit)])
            at = row[hit[new]]
            begin = first[at].astype(np.int64) + step[hit[new]]
            count = np.diff(np.r_[new, len(hit)])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("tid").take(pa.array(at)),
                    pa.array(begin),
                    pa.array(begin + count + least_words - 1),
                ],
                names=["tid", "begin", "end"],
            )

    return (
        given.repartition("value")
        .sortWithinPartitions("value")
        .mapInArrow(tidy(run), "tid bigint, begin bigint, end bigint")
    )


def hashed_windows(given: DataFrame, least_words: int) -> DataFrame:
    """``compared_windows`` for values of many runs: a row per window, no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, row, step, start = spread_windows(batch)
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    *(
                        pa.array(byte_grams(words, least_words, x)[start].view(np.int64))
                        for x in (False, True)
                    ),
                    *(batch.column(n).take(own) for n in ("tid", "last", "doc_id", "h")),
                    pa.array(batch.column("first").to_numpy()[row] + step),
                ],
                names=["f1", "f2", "tid", "last", "doc_id", "h", "begin"],
            )

    rows = stored(
        given.mapInArrow(
            tidy(run),
            "f1 bigint, f2 bigint, tid bigint, last boolean, doc_id bigint, h bigint,"
            " begin bigint",
        ),
        "windows",
    )
    place = F.struct("last", "doc_id", "h", "tid")
    several = stored(
        rows.groupBy("f1", "f2")
        .agg(F.count("*").alias("n"), F.min(place).alias("keep"), F.max("tid").alias("most"))
        .where("n > 1"),
        "several",
    )
    met = spread_join(rows, several, ["f1", "f2"], "n", rows.count())
    return met.where(F.col("tid") != F.col("keep.tid")).select(
        "tid", "begin", (F.col("begin") + least_words).alias("end")
    )


def equal_windows(texts: DataFrame, least_words: int, hot: int) -> DataFrame:
    """tid, begin, end: word ranges of ``least_words`` words that an earlier document has."""
    found = stored(word_runs(texts, least_words), "runs")
    several = stored(
        found.groupBy("value")
        .agg(F.count("*").alias("n"), F.min("tid").alias("a"), F.max("tid").alias("b"))
        .where("a <> b")
        .select("value", "n"),
        "values",
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

    def wanted(is_hot: bool) -> DataFrame:
        own = per_text.where(F.col("hot") == is_hot).drop("hot")
        return handed_words(some.join(own, "tid"), least_words)

    ranges = compared_windows(wanted(False), least_words)
    if not several.where(F.col("n") > hot).isEmpty():
        ranges = ranges.unionByName(hashed_windows(wanted(True), least_words))
    return ranges


def without_words(rows: DataFrame, columns: list[str], least_words: int) -> DataFrame:
    """``columns`` of the rows, their text without the word ranges of ``_llm_cut``."""
    spans = T.ArrayType(
        T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    )
    given = rows.select(*columns, F.col("_llm_cut").cast(spans).alias("_llm_cut"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("removed", spans)])
    text_at = columns.index("text")
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for text, cut in zip(batch.column(text_at), batch.column(batch.num_columns - 1)):
                own, gone = text, []
                if cut.is_valid and len(cut.values) and text.is_valid:
                    data = np.frombuffer(text.as_buffer(), np.uint8)
                    word, _ = word_edges(data, np.array([0, len(data)]))
                    begin, end = merged(*(cut.values.field(n).to_numpy() for n in ("begin", "end")))
                    end = np.minimum(end, len(word))
                    long = end - begin >= least_words
                    begin, end = begin[long], end[long]
                    if len(begin):
                        edges = np.r_[word, len(data)]
                        rest = zip(np.r_[0, edges[end]].tolist(), np.r_[edges[begin], len(data)].tolist())
                        own = pa.scalar(
                            b"".join([data[a:b].tobytes() for a, b in rest]).decode(), pa.string()
                        )
                        gone = [{"begin": a, "end": b} for a, b in zip(begin.tolist(), end.tolist())]
                texts.append(own.as_py())
                removed.append(gone)
            arrays = list(batch.columns[:-1])
            arrays[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(removed, kind)],
                names=[*batch.schema.names[:-1], "removed"],
            )

    return given.mapInArrow(tidy(run), schema)


def cleaned(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    least_words: int = LEAST_WORDS,
    hot: int = HOT,
) -> DataFrame:
    """``docs`` without the repeated paragraphs, and ``removed``, their word ranges."""
    mark = written()
    whole = distinct_texts(docs)
    texts = lowered(whole)
    ranges = (
        alike_lines(texts, threshold, least_words)
        .unionByName(equal_windows(texts, least_words, hot))
        .groupBy("tid")
        .agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    )
    decided = stored(
        whole.select("tid", "h", "copies", "place")
        .join(ranges, "tid", "left")
        .where("copies > 1 OR ranges IS NOT NULL")
        .select("h", "copies", F.col("place.doc_id").alias("first"), "ranges"),
        "decided",
    )
    discard(docs.sparkSession, mark)
    columns = [c for c in docs.columns if c != "removed"]
    some, rest = joined_by_text(docs.select(*columns), decided)
    copy = (F.col("_llm_copies") > 1) & ~F.col("doc_id").cast("bigint").eqNullSafe(
        F.col("_llm_first")
    )
    every = F.array(
        F.struct(F.lit(0).cast("bigint").alias("begin"), F.lit(2**31).alias("end"))
    )
    some = some.withColumn("_llm_cut", F.when(copy, every).otherwise(F.col("_llm_found")))
    rest = rest.select(
        *columns, F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("removed")
    )
    text = F.col("text").cast("string")
    return without_words(some.withColumn("text", text), columns, least_words).unionByName(
        rest.withColumn("text", text)
    )
