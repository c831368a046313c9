"""Vectorised 64-bit hashes of words, lines and shingles of Arrow text columns.

A span's hash is a polynomial over its bytes modulo 2**64, read off one running sum per chunk, then
mixed. Words are runs of bytes other than white space (0x20, 0x09-0x0D). Only A-Z are lower-cased.
All functions work on whole texts; chunks bound the memory, not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 21
SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    x = x + U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _tables():
    plain = mix(np.arange(1, 257, dtype=U64), 7)
    lower = plain.copy()
    lower[65:91] = plain[97:123]
    solid = np.ones(256, bool)
    solid[list(SPACE)] = False
    return plain, lower, solid


PLAIN, LOWER, SOLID = _tables()
BASE = 0x5851F42D4C957F2D
UNBASE = pow(BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, kept per worker and grown on need."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", BASE), ("down", UNBASE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


class Texts:
    """Bytes of some texts end to end, with the offsets of each; nulls are empty."""

    def __init__(self, column: pa.Array):
        if column.null_count:
            column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        buffer = column.buffers()[2]
        self.data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.empty(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.column = column

    def spans_hash(self, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
        """Hash of the bytes of each span [start, end); empty spans hash alike."""
        up, down = powers(len(self.data) + 1)
        running = np.zeros(len(self.data) + 1, U64)
        values = (LOWER if lower else PLAIN)[self.data]
        values *= up[:-1]
        np.cumsum(values, out=running[1:])
        return mix((running[ends] - running[starts]) * down[starts])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the index of each text's first word (one more at the end)."""
        solid = SOLID[self.data]
        inside = self.offsets[self.offsets < len(self.data)]
        opens, closes = solid.copy(), solid.copy()
        if len(solid):
            opens[1:] &= ~solid[:-1]
            closes[:-1] &= ~solid[1:]
            opens[inside] = solid[inside]
            closes[inside[inside > 0] - 1] = solid[inside[inside > 0] - 1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all lines split at newline, and each text's first line; an empty text is one line."""
        breaks = np.flatnonzero(self.data == 10)
        first = np.searchsorted(breaks, self.offsets)
        count = np.diff(first) + 1
        begin = np.concatenate(([0], np.cumsum(count)))
        starts = np.empty(begin[-1], np.int64)
        ends = np.empty(begin[-1], np.int64)
        is_first = np.zeros(begin[-1], bool)
        is_first[begin[:-1]] = True
        is_last = np.zeros(begin[-1], bool)
        is_last[begin[1:] - 1] = True
        starts[is_first], ends[is_last] = self.offsets[:-1], self.offsets[1:]
        starts[~is_first], ends[~is_last] = breaks + 1, breaks
        return starts, ends, begin

    def stripped(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans without white space at both ends; a blank span becomes empty."""
        solid = np.concatenate(([0], np.cumsum(SOLID[self.data])))
        places = np.flatnonzero(SOLID[self.data])
        low, high = solid[starts], solid[ends]
        some = high > low
        new_starts, new_ends = starts.copy(), starts.copy()
        new_starts[some], new_ends[some] = places[low[some]], places[high[some] - 1] + 1
        return new_starts, new_ends


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, Texts]]:
    """Consecutive rows as Texts of at most ``limit`` bytes, or of one longer text, with the first row's number."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    whole = Texts(column)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(whole.offsets, whole.offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, Texts(whole.column.slice(row, end - row))
        row = end


def runs(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``width`` words from each position on, and which positions have that many in their text."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, U64), np.empty(0, bool)
    total = np.zeros(count, U64)
    for step in range(width):
        total += hashes[step : step + count] * U64(pow(0xD6E8FEB86659FD93, step + 1, 2**64))
    last = np.repeat(first[1:], np.diff(first))[:count]
    return mix(total, width), np.arange(count) + width <= last


def short_hash(hashes: np.ndarray) -> np.ndarray:
    """Hash of a whole sequence of fewer words than a shingle has, apart from every shingle's."""
    factors = np.array([pow(0xD6E8FEB86659FD93, i + 1, 2**64) for i in range(len(hashes))], U64)
    return mix((hashes * factors).sum(dtype=U64, keepdims=True), 1000 + len(hashes))


def shingle_sets(texts: Texts, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    starts, ends, first = texts.words()
    words = texts.spans_hash(starts, ends)
    shingles, valid = runs(words, first, width)
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if end - begin >= width:
            yield np.unique(shingles[begin : end - width + 1])
        elif end > begin:
            yield short_hash(words[begin:end])
        else:
            yield np.empty(0, U64)
