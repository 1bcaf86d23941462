"""Vectorised scans of text columns inside Arrow functions: words, lines and 64-bit span hashes.

A text column arrives as one byte buffer with offsets. The functions here work on that buffer, in chunks
of whole rows of about ``CHUNK`` bytes (a longer row is a chunk of its own), so a task's memory stays
bounded by the longest text. A null text has no bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of A-Z as a-z, others as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C13)  # odd, and 3 modulo 8
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1, offset=column.offset * 8)
    raw = column.buffers()[2]
    return (np.frombuffer(raw, dtype=np.uint8) if raw else np.empty(0, dtype=np.uint8)), offsets


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: first row, row after the last, their bytes, and offsets that start from 0."""
    data, offsets = buffers(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values that do not pass from row to row."""
    filled = offsets[:-1] < offsets[1:]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    head, tail = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[head], end[tail] = inside[head], inside[tail]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and each row's first word (one more at the end)."""
    starts, ends = _runs(~_WHITE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the non-empty lines between ``\\n``, and each row's first line (one more at the end)."""
    starts, ends = _runs(data != 10, offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            run = np.full(max(n, CHUNK + 1), base, dtype=np.uint64)
            run[0] = 1
            _powers[i] = np.multiply.accumulate(run)
    return _powers[0], _powers[1]


class SpanHasher:
    """64-bit hashes of any spans of one byte buffer, by one pass of running sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, self.inverse = _grow(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * power[:n], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` values of one array, in order."""
    n = len(hashes) - size + 1
    out = hashes[:n].copy()
    for k in range(1, size):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + hashes[k : k + n])
    return out


def rows_of(firsts: np.ndarray) -> np.ndarray:
    """The row of each item, from each row's first item."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
