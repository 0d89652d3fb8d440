"""Words of many texts at once, as positions and 64-bit hashes in numpy.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; these never occur inside a UTF-8 sequence. The hash of
a run is a polynomial over random byte values modulo 2**64, mixed at the end, so all runs of a block
come from one running sum. Two different runs share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 1 << 20  # bytes hashed at once
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[0x0A] = True

_VALUES = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 64, 256, dtype=np.uint64)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]

_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the next call."""
    global _powers
    if _powers is None or len(_powers[0]) < length:
        size = max(length, BLOCK)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, folded: bool = False) -> np.ndarray:
    """The hash of each run data[start:end]; runs ascend and do not overlap."""
    values = _FOLDED if folded else _VALUES
    out = np.empty(len(start), np.uint64)
    low = 0
    while low < len(start):
        first = int(start[low])
        high = max(low + 1, int(np.searchsorted(end, first + BLOCK, side="right")))
        last = int(end[high - 1])
        up, down = _power_tables(last - first + 1)
        sums = np.empty(last - first + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data[first:last]] * up[: last - first], out=sums[1:])
        a, b = start[low:high] - first, end[low:high] - first
        out[low:high] = (sums[b] - sums[a]) * down[a]
        low = high
    return mix(out)


@dataclass
class Runs:
    """Runs of a chunk of texts: bytes, row of each run (from 0), and hash."""

    rows: int
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def per_row(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)


def runs(data: np.ndarray, offsets: np.ndarray, folded: bool = False, lines: bool = False) -> Runs:
    """Words, or non-empty lines, of the rows that the offsets delimit."""
    first, last = int(offsets[0]), int(offsets[-1])
    inside = ~(_NEWLINE if lines else SPACE)[data[first:last]]
    rows = len(offsets) - 1
    if last == first:
        none = np.zeros(0, np.int64)
        return Runs(rows, none, none, none, np.zeros(0, np.uint64))
    edge = np.zeros(last - first + 1, bool)  # a row begins here
    edge[offsets - first] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins) + first, np.flatnonzero(ends) + first + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Runs(rows, row, start, end, run_hashes(data, start, end, folded))


def windows(words: Runs, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word, and hash, of every run of ``n`` words inside one row."""
    count = len(words.row) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.row[:count] == words.row[n - 1 :])
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = total * np.uint64(_BASE) + words.hash[k : k + count]
    return at, mix(total[at])


def keyed(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One key of row and hash."""
    return mix(hashes + row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a value per byte over each row; the first byte is at offsets[0]."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    at = offsets - offsets[0]
    return sums[at[1:]] - sums[at[:-1]]
