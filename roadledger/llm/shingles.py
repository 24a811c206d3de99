"""Five-word shingles and MinHash values of text segments, vectorised over Arrow buffers.

A word is a run of anything but the six ASCII blanks, in lower case where the caller
lowers the text first. A segment of one to four words has one shingle, all its words; a
segment without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
#: Bytes of text whose work arrays are held at once.
SLAB = 400_000
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_CHAIN = np.uint64(0xD6E8FEB86659FD93)
_SECOND = np.uint64(0xA0761D6478BD642F | 1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        factors = np.full(max(n, SLAB + 2), base, dtype=np.uint64)
        factors[0] = 1
        held = np.cumprod(factors, dtype=np.uint64)
        if n <= SLAB + 2:
            _POWERS[int(base)] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values; a bijection."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def word_edges(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; words end at the bounds of segments."""
    inside = ~BLANK[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = bounds[(bounds > 0) & (bounds < len(data))]
    first[edge] |= inside[edge]
    last[edge - 1] |= inside[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    forward = _powers(_BASE, len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forward[:-1], out=prefix[1:])
    back = _powers(_BASE_INVERSE, len(data) + 1)
    return mix((prefix[end] - prefix[begin]) * back[begin])


def words_of_slab(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the bounds of the segments counted in words.

    A single text of more than a slab is taken in pieces that end at a blank.
    """
    if len(data) <= SLAB:
        begin, end = word_edges(data, bounds)
        return word_hashes(data, begin, end), np.searchsorted(begin, bounds)
    found, at = [], 0
    while at < len(data):
        stop = min(at + SLAB, len(data))
        while stop < len(data) and not BLANK[data[stop - 1]]:
            blank = np.flatnonzero(BLANK[data[stop : stop + SLAB]])
            stop = min(stop + (int(blank[0]) + 1 if len(blank) else SLAB), len(data))
        piece = data[at:stop]
        begin, end = word_edges(piece, np.array([0, len(piece)]))
        found.append(word_hashes(piece, begin, end))
        at = stop
    words = np.concatenate(found)
    return words, np.array([0, len(words)])


def chains(words: np.ndarray) -> np.ndarray:
    """Hash of the ``WIDTH`` words from every word that has them."""
    count = max(len(words) - WIDTH + 1, 0)
    chain = np.zeros(count, dtype=np.uint64)
    for k in range(WIDTH):
        chain = chain * _CHAIN + words[k : k + count]
    return mix(chain)


class Segments:
    """Words and shingles of segments [bounds[i], bounds[i + 1]) of ``data``.

    ``words`` counts words per segment. ``keys`` are two 64-bit hashes of the word
    sequence. ``hashes`` are shingle hashes, those of segment i from ``starts[i]`` to
    ``starts[i + 1]``.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        n = len(bounds) - 1
        begin, end = word_edges(data, bounds)
        word = word_hashes(data, begin, end)
        at = np.searchsorted(begin, bounds)
        self.words = np.diff(at)
        owner = np.repeat(np.arange(n), self.words)
        place = np.arange(len(word)) - np.repeat(at[:-1], self.words)
        self.keys = tuple(
            mix(self._sums(word * _powers(base, int(place.max(initial=0)) + 1)[place], at))
            for base in (_CHAIN, _SECOND)
        )
        whole = np.flatnonzero(
            owner[: len(word) - WIDTH + 1] == owner[WIDTH - 1 :]
            if len(word) >= WIDTH
            else np.zeros(0, dtype=bool)
        )
        chain = np.zeros(len(whole), dtype=np.uint64)
        for k in range(WIDTH):
            chain = chain * _CHAIN + word[whole + k]
        short = np.flatnonzero((self.words > 0) & (self.words < WIDTH))
        hashes = np.concatenate([mix(chain), self.keys[0][short]])
        owners = np.concatenate([owner[whole], short])
        order = np.argsort(owners, kind="stable")
        self.hashes = hashes[order]
        self.starts = np.searchsorted(owners[order], np.arange(n + 1))

    @staticmethod
    def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values, out=total[1:])
        return total[at[1:]] - total[at[:-1]]

    def set_of(self, i: int) -> np.ndarray:
        """Distinct shingle hashes of a segment, in order, as signed 64-bit."""
        own = self.hashes[self.starts[i] : self.starts[i + 1]]
        return np.unique(own.view(np.int64))

    def minhash(self, count: int, seed: int = 7) -> np.ndarray:
        """(segments, count) 32-bit MinHash values; rows without shingles are zero."""
        rng = np.random.default_rng(seed)
        flips = rng.integers(0, 2**32, count, dtype=np.uint32)
        factors = rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1)
        out = np.zeros((len(self.words), count), dtype=np.uint32)
        some = np.flatnonzero(np.diff(self.starts))
        if len(some):
            low = (self.hashes >> np.uint64(32)).astype(np.uint32)
            begins = self.starts[some]
            work = np.empty_like(low)
            for k in range(count):
                np.bitwise_xor(low, flips[k], out=work)
                np.multiply(work, factors[k], out=work)
                out[some, k] = np.minimum.reduceat(work, begins)
        return out


def hashed_bytes(minima: np.ndarray) -> np.ndarray:
    """One byte of every MinHash value, well mixed."""
    return ((minima * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def text_slabs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past last row, bytes, bounds) of a string array without nulls."""
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(offsets, offsets[begin] + SLAB, "right")) - 1
        end = min(max(end, begin + 1), len(column))
        yield (
            begin,
            end,
            data[offsets[begin] : offsets[end]],
            offsets[begin : end + 1] - offsets[begin],
        )
        begin = end
