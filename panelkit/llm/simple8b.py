"""Simple-8b: whole numbers packed into 64-bit words, each with a selector of how many and how wide.

A word's top 4 bits are the selector, the other 60 hold that many numbers of that width, first number lowest. A
number that needs over 60 bits is an escape: selector 15, and its place in a list of raw numbers. Numbers come
in blocks of ``BLOCK``; a word never spans two blocks, and the first word of each block is known, so all blocks
are coded and decoded side by side in numpy.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024

# fixed values of the coding: numbers in a word, and bits of each, by selector
COUNT = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1, 1])
WIDTH = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60, 0])
ESCAPE = 15

_TOP = np.uint64(60)


def _bits(numbers: np.ndarray) -> np.ndarray:
    """Bits each number needs, from the exponent of a float; rounding may count one too many past 53."""
    exponent = (numbers.astype(np.float64).view(np.int64) >> 52) - 1022
    return np.maximum(exponent, 0).astype(np.uint8)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place of each block (a row, followed by 60 zeros): the selector that packs most from there."""
    size = bits.shape[1] - 60
    best = np.full((len(bits), size), ESCAPE, np.uint8)
    widest, reach = bits.copy(), 1  # of the next ``reach`` numbers
    for s in range(13, -1, -1):
        while reach < COUNT[s]:
            step = min(reach, int(COUNT[s]) - reach)
            widest[:, : -step or None] = np.maximum(widest[:, : -step or None], widest[:, step:])
            reach += step
        np.putmask(best, widest[:, :size] <= WIDTH[s], np.uint8(s))
    return best


def pack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, the first word of each block (and their end), and the escaped numbers."""
    total = len(numbers)
    blocks = -(-total // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.int32), np.zeros(0, np.uint64)
    bits = np.zeros(blocks * BLOCK, np.uint8)
    bits[:total] = _bits(numbers)
    padded = np.zeros((blocks, BLOCK + 60), np.uint8)
    padded[:, :BLOCK] = bits.reshape(blocks, BLOCK)
    selector = _selectors(padded)

    length = np.full(blocks, BLOCK)
    length[-1] = total - (blocks - 1) * BLOCK
    lane, at, lanes, places = np.arange(blocks), np.zeros(blocks, np.int64), [], []
    while len(lane):  # one word of every block at a time
        lanes.append(lane)
        places.append(at)
        at = at + COUNT[selector[lane, at]]
        more = at < length[lane]
        lane, at = lane[more], at[more]
    row, place = np.concatenate(lanes), np.concatenate(places)
    step = np.repeat(np.arange(len(lanes)), [len(x) for x in lanes])
    starts = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=blocks))))
    first, kind = np.empty(len(row), np.int64), np.empty(len(row), np.uint8)
    order = starts[row] + step
    first[order], kind[order] = row * BLOCK + place, selector[row, place]

    shift = (np.arange(total) - np.repeat(first, np.diff(np.append(first, total)))) * np.repeat(WIDTH[kind], np.diff(np.append(first, total)))
    values = np.asarray(numbers, np.uint64) << shift.astype(np.uint64)
    out = kind == ESCAPE
    escapes = np.asarray(numbers, np.uint64)[first[out]]
    values[first[out]] = np.arange(len(escapes), dtype=np.uint64)
    words = np.bitwise_or.reduceat(values, first) | (kind.astype(np.uint64) << _TOP)
    return words, starts.astype(np.int32), escapes


def unpack(words: np.ndarray, starts: np.ndarray, escapes: np.ndarray, length: int) -> np.ndarray:
    """The numbers that were packed."""
    if not len(words):
        return np.zeros(0, np.uint64)
    kind = (words >> _TOP).astype(np.int64)
    count = COUNT[kind]
    ahead = np.concatenate(([0], np.cumsum(count)))
    block = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    first = block * BLOCK + ahead[:-1] - ahead[starts[:-1]][block]  # the last word of a block may be half empty
    held = np.diff(np.append(first, length))
    shift = (np.arange(length) - np.repeat(first, held)) * np.repeat(WIDTH[kind], held)
    mask = np.where(kind == ESCAPE, (1 << 60) - 1, (1 << WIDTH[kind]) - 1).astype(np.uint64)
    out = (np.repeat(words, held) >> shift.astype(np.uint64)) & np.repeat(mask, held)
    raw = np.repeat(kind == ESCAPE, held)
    if raw.any():
        out[raw] = escapes[out[raw].astype(np.int64)]
    return out
