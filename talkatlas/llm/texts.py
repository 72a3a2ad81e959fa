"""Whole texts of an Arrow batch as flat numpy arrays: bytes, words, word hashes.

Words are maximal runs of bytes other than ASCII white space. A NULL text is empty.
Everything here works on one block of rows at a time, and hashes long texts piece
by piece, so memory follows the block and not the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
PIECE_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_power_cache: dict[str, np.ndarray] = {}


@dataclass
class Words:
    """Words of some rows: byte ranges, and ``first[r]:first[r + 1]`` for the words of row r."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    data, offsets = raw(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(n, max(row + 1, stop))
        part = offsets[row : stop + 1]
        yield row, stop, data[part[0] : part[-1]], part - part[0]
        row = stop


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SPACE[data]
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(len(offsets), np.int64))
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, offsets, side="left"))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    if len(_power_cache.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _power_cache[name] = np.multiply.accumulate(steps)
    return _power_cache["up"], _power_cache["down"]


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for many ranges at once, from one running sum."""
    up, down = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def word_hash(words: Words) -> np.ndarray:
    """64-bit hash of every word; equal words have equal hashes in any row and batch."""
    out = np.empty(len(words.start), dtype=np.uint64)
    at = 0
    while at < len(out):
        stop = max(at + 1, int(np.searchsorted(words.end, words.start[at] + PIECE_BYTES, side="right")))
        low = words.start[at]
        out[at:stop] = spans_hash(
            words.data[low : words.end[stop - 1]], words.start[at:stop] - low, words.end[at:stop] - low
        )
        at = stop
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values; needs at least ``width`` values."""
    best, step = values, 1
    while 2 * step <= width:
        best = np.minimum(best[:-step], best[step:])
        step *= 2
    rest = width - step
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best
