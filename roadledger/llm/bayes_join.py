"""N-gram Jaccard join with Bayesian pruning of candidates.

1. Documents of the same words (lower case) are one class, found by grouping.
2. A class has ``VALUES`` MinHash values of one byte. ``BANDS`` bands of ``ROWS`` values
   give buckets; a pair of similarity 0.8 shares no bucket with probability 7e-5, one of
   0.85 with 1e-6. Only classes in buckets of two or more go on, with their values.
3. Inside a bucket, pairs compare their values step by step. With a uniform prior on the
   similarity, the posterior probability of reaching the threshold follows from the
   matches so far; below ``TOLERANCE`` the pair is dropped. Pairs never become rows: a
   bucket gives the edges that connect what stayed, fewer than it has classes. Buckets of
   more than ``BLOCK`` classes are cut into blocks, pairs of blocks go to different tasks.
4. Components of those edges hold every candidate pair. The exact shingle sets are fetched
   for their classes alone; the classes of a component meet block by block once more, what
   the comparison leaves is verified exactly, and a task returns link counts per class
   and the links that connect them.

The result has a row per document; copies stay one class and are never paired up.

Defined cases
    Null texts are empty. Documents without words take no part: class of their own, no
    links. One to four words are one shingle. Ties and repeated rows: equal texts are
    copies, each with a link to every other. ``class_id`` is the smallest doc_id of the
    component, null ids last (a component of null ids only has a null class_id). An empty
    table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadledger.llm.common import discard, parted, ship, stored, tidy, written
from roadledger.llm.components import components
from roadledger.llm.shingles import Segments, hashed_bytes, text_slabs

THRESHOLD = 0.8
ROWS, BANDS = 5, 24
STEP, VALUES = 24, 240
#: Limit of the posterior at one look; over all looks a pair at 0.8 is lost with 7.9e-5.
TOLERANCE = 1e-5
BLOCK = 512
BLOCK_SHINGLES = 400_000


def least_matches(
    threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> dict[int, int]:
    """Values compared -> fewest matches with which a pair stays.

    Uniform prior on the similarity s; values of one byte agree with probability
    s + (1 - s) / 256.
    """
    s = (np.arange(4000) + 0.5) / 4000
    agree = s + (1 - s) / 256
    least = {}
    for n in range(STEP, VALUES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(agree) + (n - m) * np.log1p(-agree)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() / weight.sum() >= tolerance:
                least[n] = m
                break
    return least


def words_of(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def text_key(column: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, rid (class of equal words, null without words), sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, bounds in text_slabs(batch.column(2)):
                own = Segments(data, bounds)
                keys = np.column_stack(own.keys).astype(">u8").tobytes()
                sig = hashed_bytes(own.minhash(VALUES)).tobytes()
                some = own.words > 0
                rid = [keys[16 * i : 16 * i + 16] if x else None for i, x in enumerate(some)]
                sig = [
                    sig[VALUES * i : VALUES * i + VALUES] if x else None
                    for i, x in enumerate(some)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        batch.column(1).slice(begin, end - begin),
                        pa.array(rid, pa.binary()),
                        pa.array(sig, pa.binary()),
                    ],
                    names=["doc_id", "text_key", "rid", "sig"],
                )

    ship(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_key().alias("text_key"),
        words_of(F.col("text")).alias("words"),
    ).mapInArrow(tidy(run), "doc_id bigint, text_key bigint, rid binary, sig binary")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """key, band, rid, n: every class in every bucket that holds n >= 2 classes."""
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.struct(
            b.alias("band"),
            F.xxhash64(b, F.substring(F.col("sig"), b * ROWS + 1, F.lit(ROWS))).alias(
                "key"
            ),
        ),
    )
    rows = classes.select("rid", F.explode(bands).alias("b")).select(
        "rid", "b.band", "b.key"
    )
    several = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(several, "key")


def close_pairs(group, own, split, sig, least, skip=None):
    """Pairs of rows (i < j) of one group that the comparison does not drop.

    Rows lie in order of ``group``. Where ``split``, a group holds two blocks and only
    rows of different ``own`` meet. ``skip`` refuses pairs that another group has.
    """
    count = len(group)
    new = np.r_[True, group[1:] != group[:-1]]
    ends = np.r_[np.flatnonzero(new)[1:], count]
    room = ends[np.cumsum(new) - 1] - np.arange(count)  # rows from here to the end
    left, right = [], []
    at = np.arange(count)
    for gap in range(1, int(room.max(initial=1))):
        at = at[room[at] > gap]
        i, j = at, at + gap
        meet = ~split[i] | (own[i] != own[j])
        if skip is not None:
            meet &= ~skip(i, j)
        i, j = i[meet], j[meet]
        matches = np.zeros(len(i), dtype=np.int64)
        for n in range(STEP, VALUES + 1, STEP):
            matches += (sig[i, n - STEP : n] == sig[j, n - STEP : n]).sum(axis=1)
            stay = matches >= least[n]
            i, j, matches = i[stay], j[stay], matches[stay]
        left.append(i)
        right.append(j)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def forest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect as much as all of them do: fewer than there are rows."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    kept = []
    for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(k)
    return i[kept], j[kept]


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]):
    """Batches cut between groups; rows come in order of the columns ``names``."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        rows = table.combine_chunks().to_batches()
        if not rows:
            continue
        last = np.ones(rows[0].num_rows, dtype=bool)
        for name in names:
            values = rows[0].column(name).to_numpy()
            last &= values == values[-1]
        cut = rows[0].num_rows - int(last.sum())
        rest = table.slice(cut)
        if cut:
            yield rows[0].slice(0, cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks().to_batches()[0]


def group_numbers(rows: pa.RecordBatch, names: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, dtype=bool)
    for name in names:
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def signatures(column: pa.Array) -> np.ndarray:
    begin = _offset(column)
    raw = np.frombuffer(column.buffers()[2], np.uint8)
    return raw[begin : begin + len(column) * VALUES].reshape(len(column), VALUES)


GROUP = ["key", "low", "high"]


def in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """The rows of a group in pairs of blocks (low, high), sorted by group and pair."""
    return (
        rows.withColumn("own", F.pmod(F.xxhash64("rid"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .repartition(*GROUP)
        .sortWithinPartitions(*GROUP)
    )


def candidate_edges(
    buckets: DataFrame, classes: DataFrame, threshold: float
) -> DataFrame:
    """a, b: pairs that connect the classes whose comparison in some bucket went well."""
    least = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, GROUP):
            low, high, own, band = (
                rows.column(n).to_numpy() for n in ("low", "high", "own", "band")
            )
            sig = signatures(rows.column("sig"))
            keys = sig[:, : ROWS * BANDS].reshape(len(sig), BANDS, ROWS)
            weights = np.uint64(256) ** np.arange(ROWS, dtype=np.uint64)
            keys = (keys.astype(np.uint64) * weights).sum(axis=2)
            earlier = np.arange(BANDS)[None, :] < band[:, None]
            i, j = close_pairs(
                group_numbers(rows, GROUP),
                own,
                low != high,
                sig,
                least,
                # A pair belongs to the first band that it shares.
                lambda i, j: ((keys[i] == keys[j]) & earlier[i]).any(axis=1),
            )
            i, j = forest(i, j)
            rid = rows.column("rid")
            yield pa.RecordBatch.from_arrays(
                [rid.take(pa.array(i)), rid.take(pa.array(j))], names=["a", "b"]
            )

    rows = buckets.join(classes.select("rid", "sig"), "rid")
    return in_blocks(rows, F.ceil(F.col("n") / BLOCK)).mapInArrow(
        tidy(run), "a binary, b binary"
    )


def shared_shingles(
    values: np.ndarray, offsets: np.ndarray, i: np.ndarray, j: np.ndarray
) -> np.ndarray:
    """Size of the intersection of sets i and j, pair by pair."""
    both = np.zeros(len(i), dtype=np.int64)
    order = np.argsort(i, kind="stable")
    firsts = np.flatnonzero(np.r_[True, i[order][1:] != i[order][:-1]]) if len(i) else ()
    for begin, end in zip(firsts, [*firsts[1:], len(order)]):
        at = order[begin:end]
        one = values[offsets[i[at[0]]] : offsets[i[at[0]] + 1]]
        others = [values[offsets[k] : offsets[k + 1]] for k in j[at].tolist()]
        every = np.concatenate(others)
        place = np.minimum(np.searchsorted(one, every), len(one) - 1)
        starts = np.cumsum([0, *[len(x) for x in others[:-1]]])
        both[at] = np.add.reduceat((one[place] == every).astype(np.int64), starts)
    return both


def verified_links(
    members: DataFrame, threshold: float
) -> DataFrame:
    """rid, partners, to: linked documents per class and block, and connecting links.

    ``members`` has rid, sig, copies, shingles, and key, n, total: its component of
    candidates with the number of classes and of shingles there. All classes of a
    component meet block by block. What leaves a task is a row per class and a
    connecting forest, never a row per pair.
    """
    least = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, GROUP):
            low, high, own, copies = (
                rows.column(n).to_numpy() for n in ("low", "high", "own", "copies")
            )
            sig, sets = signatures(rows.column("sig")), rows.column("shingles")
            offsets = sets.offsets.to_numpy().astype(np.int64)
            i, j = close_pairs(
                group_numbers(rows, GROUP), own, low != high, sig, least
            )
            both = shared_shingles(sets.values.to_numpy(), offsets, i, j)
            sizes = np.diff(offsets)
            linked = both / (sizes[i] + sizes[j] - both) >= threshold
            i, j = i[linked], j[linked]
            partners = np.zeros(rows.num_rows, dtype=np.int64)
            np.add.at(partners, i, copies[j])
            np.add.at(partners, j, copies[i])
            some = np.flatnonzero(partners)
            a, b = forest(i, j)
            rid = rows.column("rid")
            yield pa.RecordBatch.from_arrays(
                [
                    rid.take(pa.array(np.concatenate([some, a]))),
                    pa.array(np.concatenate([partners[some], np.zeros_like(a)])),
                    pa.concat_arrays(
                        [pa.nulls(len(some), pa.binary()), rid.take(pa.array(b))]
                    ),
                ],
                names=["rid", "partners", "to"],
            )

    blocks = F.greatest(
        F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)
    )
    return in_blocks(members, blocks).mapInArrow(
        tidy(run), "rid binary, partners bigint, to binary"
    )


def _offset(column: pa.Array) -> int:
    """First byte of a binary array's values."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)
    return int(offsets[column.offset])


def shingle_sets(texts: DataFrame) -> DataFrame:
    """rid, shingles (distinct hashes) of ``texts`` (rid, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, bounds in text_slabs(batch.column(1)):
                own = Segments(data, bounds)
                sets = [own.set_of(i) for i in range(end - begin)]
                offsets = np.zeros(len(sets) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in sets], out=offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        pa.ListArray.from_arrays(offsets, np.concatenate(sets)),
                    ],
                    names=["rid", "shingles"],
                )

    ship(texts.sparkSession)
    return texts.select("rid", "words").mapInArrow(
        tidy(run), "rid binary, shingles array<bigint>"
    )


class Joined:
    """Classes, links and members of one table of documents."""

    def __init__(self, docs: DataFrame, threshold: float = THRESHOLD):
        self.rows = stored(signed(docs), "signed")
        place = F.struct(
            F.col("doc_id").isNull().alias("last"), "doc_id", "text_key"
        )
        self.classes = stored(
            self.rows.where("rid IS NOT NULL")
            .groupBy("rid")
            .agg(
                F.min(place).alias("first"),
                F.count("*").alias("copies"),
                F.first("sig").alias("sig"),
            ),
            "classes",
        )
        edges = candidate_edges(
            stored(shared_buckets(self.classes), "buckets"), self.classes, threshold
        )
        candidates = stored(components(edges), "candidates")
        where = stored(
            self.classes.join(candidates.withColumnRenamed("node", "rid"), "rid").select(
                "rid",
                "copies",
                "sig",
                F.xxhash64("root").alias("key"),
                F.col("first.doc_id").alias("first_id"),
                F.col("first.text_key").alias("text_key"),
            ),
            "needed",
        )
        texts = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            text_key().alias("text_key"),
            words_of(F.col("text")).alias("words"),
        )
        texts, _ = parted(texts, F.col("text_key"), where, F.col("text_key"))
        found = (
            texts.join(where.select("rid", "first_id", "text_key"), "text_key")
            .where(F.col("doc_id").eqNullSafe(F.col("first_id")))
            .select("rid", "words")
            .dropDuplicates(["rid"])
        )
        members = stored(
            where.join(shingle_sets(found), "rid").select(
                "rid", "copies", "sig", "key", "shingles"
            ),
            "members",
        )
        sizes = members.groupBy("key").agg(
            F.count("*").alias("n"), F.sum(F.size("shingles")).alias("total")
        )
        self.links = stored(
            verified_links(members.join(sizes, "key"), threshold), "links"
        )

    def groups(self) -> DataFrame:
        """rid, class_first, n_links for every class of documents."""
        links, classes = self.links, self.classes.select("rid", "first", "copies")
        roots = components(
            links.where("to IS NOT NULL").select(
                F.col("rid").alias("a"), F.col("to").alias("b")
            )
        )
        partners = links.groupBy("rid").agg(F.sum("partners").alias("partners"))
        linked = classes.join(roots.withColumnRenamed("node", "rid"), "rid")
        least = linked.groupBy("root").agg(F.min("first").alias("class_first"))
        found = linked.join(least, "root").select("rid", "class_first")
        return (
            classes.join(found, "rid", "left")
            .join(partners, "rid", "left")
            .select(
                "rid",
                F.coalesce("class_first", "first").alias("class_first"),
                (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            )
        )

    def documents(self) -> DataFrame:
        """doc_id, text_key, class_id, n_links, kept (the first text of its component)."""
        joined = self.rows.select("doc_id", "text_key", "rid").join(
            self.groups(), "rid", "left"
        )
        lone = F.col("rid").isNull()
        return joined.select(
            "doc_id",
            "text_key",
            F.when(lone, F.col("doc_id"))
            .otherwise(F.col("class_first.doc_id"))
            .alias("class_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            (
                lone
                | (
                    F.col("doc_id").eqNullSafe(F.col("class_first.doc_id"))
                    & (F.col("text_key") == F.col("class_first.text_key"))
                )
            ).alias("kept"),
        )


def join_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links: one row per document."""
    return Joined(docs, threshold).documents().select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without near copies: of each component the first document stays."""
    mark = written()
    found = Joined(docs, threshold).documents()
    grouped = found.where("n_links > 0")
    decided = stored(grouped.select("doc_id", "text_key", "kept").distinct(), "decided")
    discard(docs.sparkSession, mark)
    keyed = docs.withColumn("_llm_own", text_key())
    some, rest = parted(keyed, F.col("_llm_own"), decided, F.col("text_key"))
    decided = decided.select(
        F.col("doc_id").alias("_llm_id"),
        F.col("text_key").alias("_llm_key"),
        F.col("kept").alias("_llm_kept"),
    )
    match = (F.col("_llm_own") == F.col("_llm_key")) & F.col("doc_id").cast(
        "bigint"
    ).eqNullSafe(F.col("_llm_id"))
    judged = some.join(decided, match, "left")
    untouched = judged.where("_llm_kept IS NULL").select(*keyed.columns)
    # Rows that are equal in id and text are copies of each other: one of them stays.
    firsts = judged.where("_llm_kept").select(*keyed.columns)
    firsts = firsts.dropDuplicates(["doc_id", "_llm_own"])
    out = rest.unionByName(untouched).unionByName(firsts)
    return out.select(*docs.columns)
