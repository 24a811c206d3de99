"""Byte-level BPE encoding and decoding with recursive DuckDB queries per partition.

Encoding splits a text by the tokenizer's pattern, looks whole pieces up in the
vocabulary, and gives the distinct other pieces of a batch to a recursive query: the
token positions of every open piece join the merge table, the leftmost pair of least rank
is contracted, and a piece without such a pair leaves the recursion. Decoding joins
(part, position, id) rows with the vocabulary and concatenates in order of position. Each
Python worker has one in-memory DuckDB with one thread and a memory limit. What a query
gets is bounded, also inside a long text: pieces are learned in runs, ids are decoded in
parts of at most ``SLAB_TOKENS``, whose bytes follow each other. A worker so holds one
batch of texts and their ids beside bounded tables.

A piece of over ``LONG`` bytes would make the recursion quadratic; such pieces are
contracted one by one with a heap, by the same rule (least rank, then leftmost).

Defined cases
    A null text is empty; an empty text has no ids and decodes to no bytes. Any text decodes
    to its own UTF-8 bytes. Null id arrays decode to no bytes, ids outside the vocabulary
    (and null ids) raise an error. Repeated rows give repeated results, an empty table none;
    further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadledger.llm.common import let_go, ship

LONG = 128
#: Characters of text, pieces of one text and tokens handled at once, pieces that one
#: recursive query contracts, and pieces remembered by a worker.
SLAB_CHARS = 2_000_000
SLAB_PIECES = 300_000
SLAB_TOKENS = 100_000
LEARNT = 20_000
REMEMBERED = 150_000
MEMORY = "150MB"

CONTRACT = """
WITH RECURSIVE step(word, toks, live) AS (
  SELECT word, toks, true FROM pieces
  UNION ALL
  (WITH positions AS (
     SELECT word, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r,
            generate_subscripts(toks[2:], 1) AS pos
     FROM step WHERE live
   ), leftmost AS (
     SELECT word, min(m.id::BIGINT * 1048576 + pos) AS best
     FROM positions JOIN merges m USING (l, r) GROUP BY word
   )
   SELECT s.word,
          CASE WHEN best IS NULL THEN toks
               ELSE toks[:(best & 1048575) - 1] || [(best >> 20)::INTEGER]
                    || toks[(best & 1048575) + 2:] END,
          best IS NOT NULL
   FROM step s LEFT JOIN leftmost USING (word) WHERE s.live)
)
SELECT word, toks FROM step WHERE NOT live ORDER BY word
"""

DECODE = """
SELECT doc, string_agg(piece, '' ORDER BY pos) AS text
FROM tokens JOIN vocabulary USING (id) GROUP BY doc
"""


class Numbers(dict):
    """Piece -> its number; a piece asked for the first time gets the next one."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


class Codec:
    """Vocabulary, merge table and database of one worker.

    The database and the remembered pieces last for one task; a worker that goes on
    with other work holds only the small tables they are made from.
    """

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {
                base64.b64decode(a): int(b)
                for a, b in (line.split() for line in lines if line.strip())
            }
        ranks = self.ranks
        compiled = regex.compile(pattern)
        self.find, self.each = compiled.findall, compiled.finditer
        width = len(str(len(ranks))) + 1
        self.decimal = np.array([b"%d " % i for i in range(len(ranks))], dtype=f"S{width}")
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [
            (ranks[whole[:i]], ranks[whole[i:]], rank)
            for whole, rank in ranks.items()
            for i in range(1, len(whole))
            if whole[:i] in ranks and whole[i:] in ranks
        ]
        columns = np.array(merges, dtype=np.int32).reshape(-1, 3)
        self.merge_table = {"l": columns[:, 0], "r": columns[:, 1], "id": columns[:, 2]}
        self.pairs: dict[tuple[int, int], int] = {}
        self.db = None
        self.open()

    def open(self) -> None:
        import duckdb

        if self.db is not None:
            return
        self.forget()
        self.db = duckdb.connect(
            config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""}
        )
        self.table("merges", **self.merge_table)
        self.table(
            "vocabulary",
            id=np.fromiter(self.ranks.values(), np.int32),
            # One character per byte; NUL, which SQL strings dislike, as U+0100.
            piece=[b.decode("latin-1").replace("\0", "Ā") for b in self.ranks],
        )

    def close(self) -> None:
        if self.db is not None:
            self.db.close()
        self.db, self.pairs = None, {}
        self.forget()
        let_go()

    def forget(self) -> None:
        """Start again without remembered pieces."""
        self.number = Numbers()
        #: Ids of the piece with that number, as bytes of 32-bit integers.
        self.known: list[bytes] = []

    def table(self, name: str, **columns) -> None:
        given = pa.table(columns)
        self.db.register("given", given)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The pieces as numbers, which take little room until they are learnt."""
        return np.fromiter(map(self.number.__getitem__, pieces), np.int32, len(pieces))

    def learn(self) -> None:
        """Find the ids of the pieces that were numbered since the last call."""
        fresh = islice(self.number, len(self.known), None)
        while pieces := list(islice(fresh, LEARNT)):
            self.known += self.contracted([piece.encode() for piece in pieces])

    def contracted(self, pieces: list[bytes]) -> list[bytes]:
        out, places, raw = [b""] * len(pieces), [], []
        for i, data in enumerate(pieces):
            rank = self.ranks.get(data)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(data) > LONG:
                out[i] = self.by_heap(data).tobytes()
            else:
                places.append(i)
                raw.append(data)
        if not raw:
            return out
        offsets = np.zeros(len(raw) + 1, dtype=np.int32)
        np.cumsum([len(r) for r in raw], out=offsets[1:])
        tokens = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        self.db.register(
            "pieces",
            pa.table(
                {
                    "word": pa.array(np.arange(len(raw), dtype=np.int32)),
                    "toks": pa.ListArray.from_arrays(offsets, tokens),
                }
            ),
        )
        done = self.db.sql(CONTRACT).to_arrow_table().column("toks").combine_chunks()
        if isinstance(done, pa.ChunkedArray):
            done = done.chunk(0)
        self.db.unregister("pieces")
        ids = done.flatten().to_numpy().astype("<i4", copy=False).tobytes()
        ends = np.cumsum(done.value_lengths().to_numpy()) * 4
        begin = 0
        for i, end in zip(places, ends.tolist()):
            out[i] = ids[begin:end]
            begin = end
        return out

    def by_heap(self, data: bytes) -> np.ndarray:
        if not self.pairs:
            left, right, rank = (x.tolist() for x in self.merge_table.values())
            self.pairs = dict(zip(zip(left, right), rank))
        token = self.byte_ids[np.frombuffer(data, np.uint8)].tolist()
        after = list(range(1, len(token))) + [-1]
        before = list(range(-1, len(token) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                pair = token[i], token[after[i]]
                if pair in self.pairs:
                    heapq.heappush(heap, (self.pairs[pair], i, *pair))

        for i in range(len(token)):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if token[i] != left or j < 0 or token[j] != right:
                continue
            token[i], token[j] = rank, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return np.array([t for t in token if t >= 0], dtype=np.int32)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as bytes of 32-bit integers."""
        if len(texts) == 1 and len(texts[0]) > SLAB_CHARS:
            return [b"".join(self.encode_runs(texts[0]))]
        if len(self.number) > REMEMBERED:
            self.forget()
        numbers = [self.numbers(self.find(text)) for text in texts]
        self.learn()
        return [self.joined(own) for own in numbers]

    def encode_runs(self, text: str) -> Iterator[bytes]:
        """The ids of a long text, a bounded run of pieces at a time."""
        found = (m.group() for m in self.each(text))
        while run := list(islice(found, SLAB_PIECES)):
            if len(self.number) > REMEMBERED:
                self.forget()
            numbers = self.numbers(run)
            self.learn()
            yield self.joined(numbers)

    def joined(self, numbers: np.ndarray) -> bytes:
        return b"".join(map(self.known.__getitem__, numbers.tolist()))

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.ranks)):
            raise ValueError("an id lies outside the vocabulary")
        # Parts of at most SLAB_TOKENS ids; those of one text follow each other.
        count = np.maximum(-(-sizes // SLAB_TOKENS), 1)
        owner = np.repeat(np.arange(len(sizes)), count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        size = np.clip(sizes[owner] - place * SLAB_TOKENS, 0, SLAB_TOKENS)
        begin = np.cumsum(size) - size
        out: list[list[bytes]] = [[] for _ in sizes]
        for low, high in slabs(size, SLAB_TOKENS):
            own = ids[begin[low] : begin[high - 1] + size[high - 1]]
            for i, part in enumerate(self.decode_parts(own, size[low:high]), low):
                out[owner[i]].append(part)
        return [b"".join(parts) for parts in out]

    def decode_parts(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        begins = np.cumsum(sizes) - sizes
        self.db.register(
            "tokens",
            pa.table(
                {
                    "doc": np.repeat(np.arange(len(sizes), dtype=np.int32), sizes),
                    "pos": (np.arange(len(ids)) - np.repeat(begins, sizes)).astype(np.int32),
                    "id": ids,
                }
            ),
        )
        out = [b""] * len(sizes)
        for doc, text in self.db.execute(DECODE).fetchall():
            out[doc] = text.replace("Ā", "\0").encode("latin-1")
        self.db.unregister("tokens")
        return out

    def digest(self, ids: np.ndarray) -> str:
        """SHA-256 of the decimal ids, joined by single spaces."""
        state = hashlib.sha256()
        for begin in range(0, len(ids), SLAB_TOKENS):
            part = ids[begin : begin + SLAB_TOKENS]
            text = self.decimal[part].tobytes().translate(None, b"\0")
            state.update(text if begin + len(part) < len(ids) else text[:-1])
        return state.hexdigest()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    _CODECS[path, pattern].open()
    return _CODECS[path, pattern]


def closing(batches, path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """The batches of a task, after which the worker lets go of its database."""
    try:
        yield from batches
    finally:
        codec(path, pattern).close()


def slabs(weights: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows, each of at most about ``most`` in weight."""
    begin, load = 0, 0
    for i, weight in enumerate(weights.tolist()):
        if i > begin and load + weight > most:
            yield begin, i
            begin, load = i, 0
        load += weight
    if begin < len(weights):
        yield begin, len(weights)


def encode_batches(batches, path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    own = codec(path, pattern)
    for batch in batches:
        column = batch.column(1)
        weights = np.diff(
            np.frombuffer(column.buffers()[1], np.int32)[
                column.offset : column.offset + len(column) + 1
            ]
        )
        for begin, end in slabs(weights, SLAB_CHARS):
            ids = own.encode(column.slice(begin, end - begin).to_pylist())
            offsets = np.zeros(len(ids) + 1, dtype=np.int32)
            np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
            values = np.frombuffer(b"".join(ids), np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(begin, end - begin),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                names=["doc_id", "ids"],
            )


#: What ``decode_batches`` can return, and its types.
OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32())),
    "decoded": ("binary", pa.binary()),
    "n_tokens": ("bigint", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def decode_batches(
    batches, path: str, pattern: str, outputs: tuple[str, ...] = ("ids", "decoded")
) -> Iterator[pa.RecordBatch]:
    """doc_id and the ``outputs`` for batches of (doc_id, ids)."""
    own = codec(path, pattern)
    for batch in batches:
        sizes = batch.column(1).value_lengths().fill_null(0).to_numpy()
        for begin, end in slabs(sizes, SLAB_TOKENS):
            rows = batch.slice(begin, end - begin)
            values = rows.column(1).flatten()
            if values.null_count:
                raise ValueError("an id is null")
            values = values.to_numpy().astype(np.int32, copy=False)
            size = sizes[begin:end].astype(np.int64)
            texts = own.decode(values, size)
            columns: list[pa.Array] = [rows.column(0)]
            for name in outputs:
                if name == "ids":
                    columns.append(rows.column(1))
                    continue
                if name == "n_tokens":
                    made = size
                elif name == "ids_sha256":
                    ends = np.cumsum(size)
                    made = [own.digest(values[a:b]) for a, b in zip(ends - size, ends)]
                elif name == "decoded":
                    made = texts
                else:
                    made = [hashlib.sha256(t).hexdigest() for t in texts]
                columns.append(pa.array(made, OUTPUTS[name][1]))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *outputs])


def _texts(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids of ``docs`` (doc_id, text)."""
    return _texts(docs).mapInArrow(
        lambda batches: closing(encode_batches(batches, path, pattern), path, pattern),
        "doc_id bigint, ids array<int>",
    )


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, decoded of ``encoded`` (doc_id, ids)."""
    ship(encoded.sparkSession)
    return encoded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(
        lambda batches: closing(decode_batches(batches, path, pattern), path, pattern),
        "doc_id bigint, ids array<int>, decoded binary",
    )


def encode_and_decode(
    docs: DataFrame, path: str, pattern: str, outputs: tuple[str, ...] = ("ids", "decoded")
) -> DataFrame:
    """doc_id and the ``outputs``: the ids are decoded in the worker that made them."""
    return _texts(docs).mapInArrow(
        lambda batches: closing(
            decode_batches(encode_batches(batches, path, pattern), path, pattern, outputs),
            path,
            pattern,
        ),
        ", ".join(["doc_id bigint", *(f"{n} {OUTPUTS[n][0]}" for n in outputs)]),
    )
