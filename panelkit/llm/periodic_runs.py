"""Runs of words that repeat with a period, found by the branching-tandem test on an enhanced suffix array.

Per text: suffix array, inverse and LCP of its words. An interval of suffixes that share exactly ``depth`` first words is an inner node of
the suffix tree; the tree itself is never made. For each suffix ``i`` in all children of an interval but the largest, ``i + depth`` and
``i - depth`` are looked up in the inverse: if one lies in the interval but not in the child of ``i``, there is a square of that period that
does not go on to the right. Rotating each square to the left as far as words agree gives its run; a run found with several periods has
the smallest. All of it runs on whole chunks of texts in numpy, in tasks, without a shuffle: words of different texts never compare as equal.

A chunk holds about ``CHUNK_BYTES`` of text, and a longer text is a chunk of its own: some 150 bytes a word, and 4 for each doubling of
the longest repeat. ``MIN_LENGTH`` is a parameter of ``find_runs``.

Defined cases: null and empty texts have no words and no runs; a null id leaves the words as they are; repeated rows get a row each;
no columns but those asked for are read, and they keep their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import added, chunks, utf8
from .wordscan import Runs, keyed, runs

MIN_LENGTH = 12  # words of the shortest run


@dataclass
class SuffixArray:
    """Suffixes in order, the place of each, the LCP with the one before, and the ranks by the first 1, 2, 4, ... words."""

    order: np.ndarray
    place: np.ndarray
    lcp: np.ndarray
    levels: list[np.ndarray]


def _starts(x: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it."""
    out = np.ones(len(x), bool)
    out[1:] = x[1:] != x[:-1]
    return out


def suffix_array(symbols: np.ndarray, end: np.ndarray) -> SuffixArray:
    """By doubling; only suffixes whose place is still open are sorted again. ``end`` is where the text of each position ends."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    place = np.empty(n, np.int64)
    head = _starts(symbols[order])
    place[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    open_ = order[~(head & np.append(head[1:], True))]
    levels, h = [], 1
    while True:
        levels.append(place.astype(np.int32) if n < 2**31 else place)
        if not len(open_):
            break
        inside = open_ + h < end[open_]
        second = np.where(inside, place[np.where(inside, open_ + h, 0)] + 1, 0)
        key = place[open_] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        first = _starts(place[open_])
        at = np.arange(len(open_))
        spot = place[open_] + at - np.maximum.accumulate(np.where(first, at, 0))
        head = _starts(key)
        place = place.copy()
        place[open_] = spot[np.maximum.accumulate(np.where(head, at, 0))]
        order[spot] = open_
        open_ = open_[~(head & np.append(head[1:], True))]
        h *= 2
    levels = [np.append(x, -1) for x in levels]  # past the last word
    lcp = np.zeros(n + 1, np.int64)
    pair = np.flatnonzero(levels[0][order[:-1]] == levels[0][order[1:]])
    lcp[pair + 1] = common(levels, order[pair], order[pair + 1], 1)
    return SuffixArray(order, place, lcp, levels)


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on (step 1), or before them (step -1). Equal ranks mean equal words of one text."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        h = 1 << k
        x, y = (a + length, b + length) if step > 0 else (a - length - h, b - length - h)
        inside = np.minimum(x, y) >= 0
        same = inside & (levels[k][np.where(inside, x, 0)] == levels[k][np.where(inside, y, 0)])
        length += same * h
    return length


def _smaller(lcp: np.ndarray, at: np.ndarray, step: int, or_equal: bool) -> np.ndarray:
    """For each place in ``at`` the nearest one in direction ``step`` with a smaller (or equal) LCP. Links are followed and doubled at once."""
    link = np.arange(len(lcp)) + step
    open_ = at
    while True:
        low = lcp[link[open_]]
        open_ = open_[low > lcp[open_] if or_equal else low >= lcp[open_]]
        if not len(open_):
            return link[at]
        link[open_] = link[link[open_]]


def branching_squares(sa: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square whose next word would break the period; some more than once."""
    n, lcp = len(sa.order), sa.lcp
    at = np.flatnonzero(lcp)
    if not len(at):
        return at, at
    before, low = _smaller(lcp, at, -1, True), _smaller(lcp, at, -1, False)
    after, high = _smaller(lcp, at, 1, True), _smaller(lcp, at, 1, False)
    last = lcp[after] < lcp[at]  # the last boundary of an interval also has the child to its right
    child_low = np.concatenate((before, at[last]))
    child_high = np.concatenate((at, high[last]))  # exclusive
    low, high = np.concatenate((low, low[last])), np.concatenate((high, high[last]))
    depth = np.concatenate((lcp[at], lcp[at[last]]))
    size = child_high - child_low
    by = np.lexsort((-size, high, low))  # an interval is its two ends; its largest child comes first
    largest = _starts(low[by]) | _starts(high[by])
    small = by[~largest]
    count = size[small]
    child = np.repeat(small, count)
    if not len(child):
        return child, child
    offset = np.arange(len(child)) - np.repeat(np.cumsum(count) - count, count)
    i, period = sa.order[child_low[child] + offset], depth[child]
    found = []
    for other, start in ((i + period, i), (i - period, i - period)):
        inside = (other >= 0) & (other < n)
        p = sa.place[np.where(inside, other, 0)]
        hit = inside & (p >= low[child]) & (p < high[child]) & ((p < child_low[child]) | (p >= child_high[child]))
        found.append((start[hit], period[hit]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def find_runs(symbols: np.ndarray, end: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and smallest period of every run, by start and period.

    ``symbols`` are the words of several texts as numbers that no two texts share; ``end`` is where the text of each word ends.
    """
    if not len(symbols):
        none = np.zeros(0, np.int64)
        return none, none, none
    sa = suffix_array(symbols, end)
    start, period = branching_squares(sa)
    stop = start + 2 * period
    start = start - common(sa.levels, start, start + period, -1)
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    keep = (_starts(start) | _starts(stop)) & (stop - start >= min_length)
    start, stop, period = start[keep], stop[keep], period[keep]
    by = np.lexsort((period, start))
    return start[by], stop[by], period[by]


def _looped(words: Runs, checksum: np.ndarray) -> np.ndarray:
    """For each word of the chunk the one that stands there: rows whose checksum ends in 0 go on periodically from some word."""
    count = words.per_row()
    source = np.arange(len(words.row))
    g, n = checksum // 10, np.maximum(count, 1)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    looped = (checksum >= 0) & (checksum % 10 == 0)
    first = np.cumsum(count) - count
    i = source - first[words.row]
    own = looped[words.row] & (i >= a[words.row])
    r = words.row[own]
    source[own] = first[r] + a[r] + (i[own] - a[r]) % p[r]
    return source


def _joined(data: np.ndarray, words: Runs, source: np.ndarray, row: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The chosen words of all rows with a space after each, and where each row's begin."""
    start, length = words.start[source], words.end[source] - words.start[source] + 1
    stop = np.cumsum(length)
    from_ = np.repeat(start - (stop - length), length) + np.arange(int(stop[-1]) if len(stop) else 0)
    out = data[np.minimum(from_, len(data) - 1)] if len(from_) else np.zeros(0, np.uint8)
    out[stop - 1] = 0x20
    per_row = np.bincount(row, weights=length, minlength=words.rows).astype(np.int64)
    return out.tobytes(), np.concatenate(([0], np.cumsum(per_row)))


def _chunk(data: np.ndarray, offsets: np.ndarray, checksum: np.ndarray, min_length: int) -> list[tuple]:
    """Per row of a chunk: number of words, of runs, the longest run, hashes of the runs and of the words that no run repeats."""
    words = runs(data, offsets)
    count = words.per_row()
    last = np.cumsum(count)
    first = last - count
    source = _looped(words, checksum)
    _, symbols = np.unique(keyed(words.row, words.hash), return_inverse=True)
    start, stop, period = find_runs(symbols[source], last[words.row], min_length)
    covered = np.zeros(len(words.row) + 1, np.int64)
    np.add.at(covered, start + period, 1)
    np.add.at(covered, stop, -1)
    kept = np.cumsum(covered[:-1]) == 0
    text, at = _joined(data, words, source[kept], words.row[kept])
    of = words.row[start] if len(start) else start
    from_, to = np.searchsorted(of, np.arange(words.rows)), np.searchsorted(of, np.arange(words.rows), side="right")
    out = []
    for k in range(words.rows):
        own = slice(from_[k], to[k])
        s, length, p = (start[own] - first[k]).tolist(), (stop[own] - start[own]).tolist(), period[own].tolist()
        best = min(zip([-x for x in length], s, p, strict=True)) if s else None
        longest = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s, length, p, strict=True))
        hashes = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text[at[k] : max(at[k + 1] - 1, at[k])]).hexdigest()
        out.append((int(count[k]), len(s), *longest, *hashes))
    return out


FIELDS = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(docs: DataFrame, keep: list[str], loop_by: Column | None = None, min_length: int = MIN_LENGTH) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` (text), what runs its words have, and a hash of its words without the repeats.

    ``loop_by`` is a checksum from 0 on: a row where it ends in 0 is read as if its words went on periodically from one on; null or -1 leaves them.
    """
    checksum = F.coalesce(loop_by.cast("long"), F.lit(-1)) if loop_by is not None else F.lit(-1)
    columns = docs.select(*keep, F.col("text").alias("__text"), checksum.cast("long").alias("__loop"))
    schema = added(docs, keep, FIELDS)
    types = [pa.int64()] * 6 + [pa.string()] * 2
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = utf8(batch.column("__text"))
            checksums = batch.column("__loop").to_numpy(zero_copy_only=False)
            rows = [r for low, high in chunks(offsets) for r in _chunk(data, offsets[low : high + 1], checksums[low:high], min_length)]
            made = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], *made], [*keep, *names])

    return columns.mapInArrow(run, schema)
