"""Token counts of sections, from one encoding of the whole document.

A document is encoded once. Token lengths in bytes give byte offsets, these character
offsets, and the token intervals are joined to the section intervals by binary search, both
being in order. A token that crosses a boundary goes to one section by an explicit rule:

``midpoint``
    the section that holds the middle of the token's characters, a middle on the boundary
    counting for the earlier section, so of two sections the one with more of it;
``start`` / ``end``
    the section that holds its first / last character.

Sections that tile a text therefore share out its tokens without rest or repetition.

Defined cases
    A null text is empty. Without ``sections`` the sections are the lines, each with the line
    feed that ends it; an empty text is one empty section. Given sections may overlap, leave
    gaps, come in any order, be empty or reach beyond the text; each is counted by itself, and
    null arrays or null bounds give no row. A token inside one character covers that
    character. Repeated rows give repeated results, an empty table none; further columns of
    the input are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadledger.llm.common import ship

RULES = ("midpoint", "start", "end")
SCHEMA = (
    "doc_id bigint, section int, start bigint, end bigint, n_tokens bigint,"
    " n_crossing bigint, doc_tokens bigint"
)
_ENCODERS: dict = {}


def encoder(path: str, pattern: str):
    """(tiktoken encoding, token lengths in bytes), made once per Python worker."""
    if (path, pattern) not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {
                base64.b64decode(a): int(b)
                for a, b in (line.split() for line in lines if line.strip())
            }
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        _ENCODERS[path, pattern] = (encoding, lengths)
    return _ENCODERS[path, pattern]


def token_spans(text: str, encoding, lengths) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last character of every token, both in order."""
    ids = np.asarray(encoding.encode_ordinary(text), dtype=np.int64)
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    if len(raw) != len(text):
        character = np.cumsum((raw & 0xC0) != 0x80)
        starts, ends = character[starts] - 1, character[ends - 1]
    return starts, ends


def line_sections(text: str) -> np.ndarray:
    """(n, 2) bounds of the lines, each with its line feed."""
    cuts = [0]
    at = text.find("\n")
    while at >= 0:
        cuts.append(at + 1)
        at = text.find("\n", at + 1)
    if cuts[-1] < len(text) or len(cuts) == 1:
        cuts.append(len(text))
    bounds = np.asarray(cuts, dtype=np.int64)
    return np.column_stack([bounds[:-1], bounds[1:]])


def join_intervals(starts, ends, sections, rule: str):
    """Tokens given to each section, and tokens that only partly lie in it."""
    low, high = sections[:, 0], np.maximum(sections[:, 0], sections[:, 1])
    if rule == "midpoint":
        key, side = starts + ends, "right"
    else:
        key, side = 2 * (starts if rule == "start" else ends - 1), "left"
    count = np.searchsorted(key, 2 * high, side) - np.searchsorted(key, 2 * low, side)
    touching = np.searchsorted(starts, high, "left") - np.searchsorted(
        ends, low, "right"
    )
    inside = np.searchsorted(ends, high, "right") - np.searchsorted(starts, low, "left")
    crossing = np.maximum(touching, 0) - np.maximum(inside, 0)
    return count, np.where(high > low, np.maximum(crossing, 0), 0)


def count_tokens(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    rule: str = "midpoint",
    sections: str | None = None,
) -> DataFrame:
    """Rows of ``SCHEMA``, one per section of ``docs`` (doc_id, text).

    ``sections`` names a column of type array<struct<start,end>> in characters.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = encoder(ranks_path, pattern)
        for batch in batches:
            given = batch.column(2) if sections else None
            blocks, size = [], 0
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                if given is None:
                    bounds = line_sections(text)
                    number = np.arange(len(bounds))
                else:
                    rows = [
                        (k, s["start"], s["end"])
                        for k, s in enumerate(given[i].as_py() or ())
                        if s and s["start"] is not None and s["end"] is not None
                    ]
                    found = np.asarray(rows, dtype=np.int64).reshape(-1, 3)
                    number, bounds = found[:, 0], found[:, 1:]
                starts, ends = token_spans(text, encoding, lengths)
                count, crossing = join_intervals(starts, ends, bounds, rule)
                blocks.append((i, number, bounds, count, crossing, len(starts)))
                size += len(number)
                if size >= 100_000:
                    yield _rows(batch, blocks)
                    blocks, size = [], 0
            if blocks:
                yield _rows(batch, blocks)

    columns = [
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ]
    if sections:
        columns.append(
            F.col(sections)
            .cast("array<struct<start:bigint,end:bigint>>")
            .alias("sections")
        )
    return docs.select(*columns).mapInArrow(run, SCHEMA)


def _rows(batch: pa.RecordBatch, blocks: list) -> pa.RecordBatch:
    sizes = [len(b[1]) for b in blocks]
    ids = batch.column(0).take(pa.array(np.repeat([b[0] for b in blocks], sizes)))
    number, bounds, count, crossing = (
        np.concatenate([b[k] for b in blocks]) for k in (1, 2, 3, 4)
    )
    total = np.repeat(np.asarray([b[5] for b in blocks], dtype=np.int64), sizes)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(number.astype(np.int32)),
            pa.array(np.ascontiguousarray(bounds[:, 0])),
            pa.array(np.ascontiguousarray(bounds[:, 1])),
            pa.array(count.astype(np.int64)),
            pa.array(crossing.astype(np.int64)),
            pa.array(total),
        ],
        names=[
            "doc_id",
            "section",
            "start",
            "end",
            "n_tokens",
            "n_crossing",
            "doc_tokens",
        ],
    )
