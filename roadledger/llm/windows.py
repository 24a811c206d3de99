"""Runs of overlapping windows that share a least hash.

All windows of one length that are equal have the same least hash over their parts, so a
corpus of windows can be dealt by that value without a row per window: neighbouring
windows mostly share it and form one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from roadledger.llm.shingles import _BASE, _BASE_INVERSE, SLAB, _powers, mix, text_slabs

_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i : i + width] for every i where that many are left."""
    n = len(values)
    if n < width:
        return values[:0]
    rows = -(-n // width)
    blocks = np.full(rows * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def byte_grams(data: np.ndarray, width: int, second: bool = False) -> np.ndarray:
    """64-bit hash of the ``width`` bytes at every position that has them."""
    n = len(data)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    values = data.astype(np.uint64) + np.uint64(1)
    if second:
        values = mix(values * _OTHER)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _powers(_BASE, n), out=prefix[1:])
    return mix((prefix[width:] - prefix[:-width]) * _powers(_BASE_INVERSE, n)[: n - width + 1])


def runs(
    hashes: np.ndarray, bounds: np.ndarray, parts: int, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(value, segment, first window, windows) of the segments [bounds[i], bounds[i + 1]).

    ``hashes`` has a hash for every position; a window holds ``length`` positions and the
    ``parts`` first of their hashes. A run has at most ``parts`` windows; windows never
    cross segments. ``first`` counts from the segment's begin.
    """
    none = np.zeros(0, dtype=np.int64)
    least = sliding_least(hashes, parts)
    count = int(bounds[-1]) - length + 1
    if count <= 0:
        return none.view(np.uint64), none, none, none
    least = least[:count]
    shut = np.zeros(count + 1, dtype=np.int64)
    inner = bounds[1:-1]
    np.add.at(shut, np.clip(inner - length + 1, 0, count), 1)
    np.add.at(shut, np.clip(inner, 0, count), -1)
    open_ = np.cumsum(shut[:-1]) == 0
    new = open_.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~open_[:-1]
    # Windows of empty or short segments are shut, so a segment's first window is new.
    begin = np.flatnonzero(new)
    stop = np.flatnonzero(new | ~open_)
    nearest = np.searchsorted(stop, begin, "right")
    end = np.r_[stop, count][nearest]
    pieces = -(-(end - begin) // parts)
    rank = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin, end = np.repeat(begin, pieces) + rank * parts, np.repeat(end, pieces)
    size = np.minimum(end - begin, parts)
    segment = np.searchsorted(bounds, begin, "right") - 1
    return least[begin], segment, begin - bounds[segment], size


def repeated_values(hashes: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether a run's value is the hash of several of the positions at hand.

    Only then can two windows of one run be equal. Run values are least hashes, so few
    positions come into question.
    """
    if not len(value):
        return np.zeros(0, dtype=bool)
    low = np.sort(hashes[hashes <= value.max()])
    twice = np.unique(low[1:][low[1:] == low[:-1]])
    at = np.minimum(np.searchsorted(twice, value), max(len(twice) - 1, 0))
    return twice[at] == value if len(twice) else np.zeros(len(value), dtype=bool)


def bounded_slabs(
    column: pa.Array, overlap: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(rows, bytes, bounds, skipped bytes): texts in slabs, long ones in pieces.

    Pieces of a text share ``overlap`` bytes, so a window of one more byte lies in exactly
    one of them.
    """
    for begin, end, data, bounds in text_slabs(column):
        if len(data) <= SLAB:
            yield np.arange(begin, end), data, bounds, 0
            continue
        for at in range(0, len(data), SLAB):
            piece = data[at : at + SLAB + overlap]
            yield np.array([begin]), piece, np.array([0, len(piece)]), at
            if at + SLAB + overlap >= len(data):
                break
