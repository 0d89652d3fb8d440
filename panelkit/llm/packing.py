"""Packing of token ids into windows by the sum-of-squares rule.

Documents come online. Each goes to the fill level at which the squared counts of partially filled windows, by
level, sum to least: into a window of level h, which then counts at h + length, or into a new one. A level array
holds the counts. What exceeds a window fills windows of its own first; its rest is placed by the rule.

Every task packs the documents it reads, so nothing is shuffled and a task that is run again packs alike. When its input ends,
some windows are partly filled; the emptiest are then cut up to fill the fullest, which leaves one, and that is cut
into windows whose lengths are powers of two, which need no padding.

Defined cases: null and empty texts are the end id alone; repeated rows are packed each; ties go to the lowest level,
a new window last; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, released, utf8
from .tokens import encoder

WINDOW = 4096

Piece = tuple[int | None, int, bytes, int]  # doc_id, ids of the document before it, ids, ids of the document


class Packer:
    """Windows under way in one task. A window is a list of pieces."""

    def __init__(self, size: int = WINDOW):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)  # the level array: open windows by fill
        self.open: dict[int, list[list[Piece]]] = {}

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[list[Piece]]:
        """Place a document; yields the windows this fills."""
        total = len(ids) // 4
        at = 0
        while total - at >= self.size:
            yield [(doc_id, at, ids[4 * at : 4 * (at + self.size)], total)]
            at += self.size
        if at < total:
            yield from self._place((doc_id, at, ids[4 * at :], total))

    def _place(self, piece: Piece) -> Iterator[list[Piece]]:
        n = len(piece[2]) // 4
        levels = np.flatnonzero(self.count[: self.size - n + 1])
        # what the sum of squares gains: a window less at h, one more at h + n; full ones don't count
        change = np.where(levels + n < self.size, 2 * self.count[levels + n] + 1, 0) - 2 * self.count[levels] + 1
        best = int(np.argmin(change)) if len(levels) else -1
        if best >= 0 and change[best] <= 2 * self.count[n] + 1:
            level = int(levels[best])
            window = self.open[level].pop()
            self.count[level] -= 1
        else:
            level, window = 0, []
        window.append(piece)
        level += n
        if level == self.size:
            yield window
        else:
            self.open.setdefault(level, []).append(window)
            self.count[level] += 1

    def finish(self) -> Iterator[list[Piece]]:
        """Close what is open: full windows, then windows of the sizes of powers of two."""
        left = [(level, w) for level in sorted(self.open, reverse=True) for w in self.open[level]]
        low, spare = 0, []  # pieces of the emptiest windows, to be handed out
        while low < len(left):
            level, window = left[low]
            low += 1
            while level < self.size and (spare or low < len(left)):
                if not spare:
                    spare = left.pop()[1][::-1]
                piece, rest = _cut(spare.pop(), self.size - level)
                if rest:
                    spare.append(rest)
                window.append(piece)
                level += len(piece[2]) // 4
            if level == self.size:
                yield window
            else:
                spare = window[::-1]
        while spare:  # in the end, under one window or, if the last was just filled, the rest of the last cut
            total = sum(len(p[2]) // 4 for p in spare)
            size = min(self.size, 1 << (total.bit_length() - 1))
            window, level = [], 0
            while level < size:
                piece, rest = _cut(spare.pop(), size - level)
                if rest:
                    spare.append(rest)
                window.append(piece)
                level += len(piece[2]) // 4
            yield window
        self.open, self.count[:] = {}, 0


def _cut(piece: Piece, n: int) -> tuple[Piece, Piece | None]:
    """At most the first n ids of a piece, and the rest."""
    doc_id, start, ids, total = piece
    if len(ids) <= 4 * n:
        return piece, None
    return (doc_id, start, ids[: 4 * n], total), (doc_id, start + n, ids[4 * n :], total)


def pack(docs: DataFrame, tokenizer: str, end_id: int, with_ids: bool = False) -> DataFrame:
    """A row per piece of ``docs`` (doc_id, text): where it comes from and where it lies.

    ``sequence_id`` is unique; its upper half is the task.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        packer, done = Packer(), 0

        def rows(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal done
            out: list[tuple] = []
            for window in windows:
                offset = 0
                for doc_id, start, ids, total in window:
                    n = len(ids) // 4
                    out.append((doc_id, start, n, zlib.crc32(ids), total, first + done, offset, ids))
                    offset += n
                done += 1
            columns = {name: pa.array([x[i] for x in out], pa.int64()) for i, name in enumerate(names)}
            if with_ids:
                columns["ids"] = pa.array([np.frombuffer(x[7], "<u4").astype(np.int32) for x in out], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(columns)

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for low, high in chunks(utf8(texts)[1]):
                full = []
                for key, ids in zip(keys[low:high], encode(texts.slice(low, high - low)), strict=True):
                    full.extend(packer.add(key, ids + end))
                if full:
                    yield rows(full)
        if full := list(packer.finish()):
            yield rows(full)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)
