"""Quality rules: how far a document's histograms are from those of its language.

Two histograms per document, character classes and common words, are held against the references of
all languages by Jensen-Shannon distance (base 2, from 0 to 1). A document is rejected if even its
nearest reference is farther than the limit. References come from all documents: sums of histograms per
``lang``; rows without a language give none. Common words are the most frequent of ``WORD_BINS`` hash bins
of a language, so what is counted has a fixed size per language whatever the vocabulary.

Guards: under ``MIN_CLASS_WORDS`` (``MIN_COMMON_WORDS``) words the first (second) distance rejects nothing, and a
language with fewer than ``MIN_REFERENCE_WORDS`` words in all gives no reference. A document whose own language has no reference, or
that has no language, is rejected by the base rules only: the other languages cannot tell whether it is clean.

Defined cases: null and empty texts have no words and fail the base rules; repeated rows are judged each on
its own; other columns are ignored; an empty table gives an empty result; a document exactly at a limit is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import added, chunks, released, utf8
from .wordscan import keyed, row_sums, runs, windows

TEXT_CHUNK = 512 * 1024  # bytes of text measured at once: histograms, words and lines of it take some 50 MB
WORD_BINS = 1 << 14
COMMON = 64  # common words of a language; all others are one more bin
MIN_CLASS_WORDS = 40
MIN_COMMON_WORDS = 40
MIN_REFERENCE_WORDS = 5_000
CLASS_LIMIT = 0.30
COMMON_LIMIT = 0.43

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

SYMBOLS = b"#*$%&|<>"
CLASSES = 9  # white space, a-z, A-Z, digits, . and comma, ! and ?, symbols, other ASCII, beyond ASCII


def _class_table() -> np.ndarray:
    kind = np.full(256, 7, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = 0
    kind[97:123], kind[65:91], kind[48:58] = 1, 2, 3
    kind[list(b".,;:'\"-()")] = 4
    kind[list(b"!?")] = 5
    kind[list(SYMBOLS)] = 6
    kind[192:] = 8
    kind[128:192] = CLASSES  # inside a character: not counted
    return kind


_CLASS = _class_table()


def _histograms(data: np.ndarray, offsets: np.ndarray, words) -> tuple[np.ndarray, np.ndarray]:
    """Character classes per row, and the hash bin of each word."""
    rows = len(offsets) - 1
    kinds = _CLASS[data[offsets[0] : offsets[-1]]]
    row = np.repeat(np.arange(rows), np.diff(offsets))
    counts = np.bincount(row * (CLASSES + 1) + kinds, minlength=rows * (CLASSES + 1))
    return counts.reshape(rows, CLASSES + 1)[:, :CLASSES], (words.hash & np.uint64(WORD_BINS - 1)).astype(np.int64)


@released
def _reference_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), object)
        for low, high in chunks(offsets, TEXT_CHUNK):
            part = offsets[low : high + 1]
            words = runs(data, part, folded=True)
            classes, bins = _histograms(data, part, words)
            for lang in {*langs[low:high]}:
                mine = langs[low:high] == lang
                total = totals.setdefault(lang, np.zeros(CLASSES + WORD_BINS, np.int64))
                total[:CLASSES] += classes[mine].sum(axis=0)
                total[CLASSES:] += np.bincount(bins[mine[words.row]], minlength=WORD_BINS)
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([lang] * len(at), pa.string()), "bin": at.astype(np.int32), "n": total[at]}
        )


def references(docs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per language: shares of character classes, bins of its common words, and their shares with the rest.

    Counted in the tasks first; the driver gets one row per language and common word.
    """
    spoken = docs.where(docs.lang.isNotNull()).select("text", "lang")
    counts = spoken.mapInArrow(_reference_parts, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    lists = counts.groupBy("lang").agg(
        F.sum(F.when(F.col("bin") >= CLASSES, F.col("n"))).alias("words"),
        F.collect_list(F.when(F.col("bin") < CLASSES, F.struct("bin", "n"))).alias("classes"),
        F.slice(
            F.sort_array(F.collect_list(F.when(F.col("bin") >= CLASSES, F.struct("n", "bin"))), asc=False), 1, COMMON
        ).alias("common"),  # at most WORD_BINS entries per language
    )
    found = {}
    for row in lists.where(F.col("words") >= MIN_REFERENCE_WORDS).orderBy("lang").collect():
        classes = np.zeros(CLASSES)
        for x in row.classes:
            classes[x.bin] = x.n
        bins = np.array([x.bin - CLASSES for x in row.common], np.int64)
        shares = np.array([x.n for x in row.common], float) / row.words
        found[row.lang] = classes / classes.sum(), bins, np.append(shares, max(0.0, 1 - shares.sum()))
    return found


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of each row of p from q."""
    m = (p + q) / 2

    def half(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0.0).sum(axis=-1)

    return np.sqrt(np.clip((half(p) + half(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def _nearest(classes: np.ndarray, words, bins: np.ndarray, refs) -> tuple[np.ndarray, np.ndarray]:
    """Distances to the nearest language, by class and by common words; 0 without words or references."""
    rows, n = words.rows, words.per_row()
    by_class, by_word = np.ones(rows), np.ones(rows)
    shares = classes / np.maximum(classes.sum(axis=1, keepdims=True), 1)
    slot = np.empty(WORD_BINS, np.int64)
    for ref_classes, ref_bins, ref_shares in refs.values():
        by_class = np.minimum(by_class, distance(shares, ref_classes))
        slot[:] = len(ref_bins)
        slot[ref_bins] = np.arange(len(ref_bins))
        size = len(ref_bins) + 1
        found = np.bincount(words.row * size + slot[bins], minlength=rows * size).reshape(rows, size)
        by_word = np.minimum(by_word, distance(found / np.maximum(n, 1)[:, None], ref_shares))
    if not refs:
        return np.zeros(rows), np.zeros(rows)
    return np.where(n > 0, by_class, 0.0), np.where(n > 0, by_word, 0.0)


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray, words) -> np.ndarray:
    """Lines with a word that equal an earlier line of the row."""
    lines = runs(data, offsets, lines=True)
    has_word = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    row, key = lines.row[has_word], keyed(lines.row, lines.hash)[has_word]
    order = np.argsort(key, kind="stable")
    again = order[1:][key[order][1:] == key[order][:-1]]
    return np.bincount(row[again], minlength=words.rows)


def _repeated_words(words) -> np.ndarray:
    """Words inside 5-word windows that occur twice or more in their row."""
    at, hashes = windows(words, WINDOW)
    key = keyed(words.row[at], hashes)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(at), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    steps = np.zeros(len(words.row) + 1, np.int32)
    np.add.at(steps, at[repeated], 1)
    np.add.at(steps, at[repeated] + WINDOW, -1)
    return np.bincount(words.row[np.cumsum(steps[:-1]) > 0], minlength=words.rows)


_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double"


def _measure(text: pa.Array, refs) -> dict[str, np.ndarray]:
    data, offsets = utf8(text)
    parts = []
    for low, high in chunks(offsets, TEXT_CHUNK):
        part = offsets[low : high + 1]
        words, folded = runs(data, part), runs(data, part, folded=True)
        classes, bins = _histograms(data, part, folded)
        by_class, by_word = _nearest(classes, folded, bins, refs)
        bytes_ = data[part[0] : part[-1]]
        parts.append(
            {
                "n_words": words.per_row(),
                "word_chars": classes[:, 1:].sum(axis=1),
                "n_symbols": row_sums(_IS_SYMBOL[bytes_], part),
                "n_dup_lines": _duplicate_lines(data, part, words),
                "n_repeat_words": _repeated_words(words),
                "class_distance": by_class,
                "word_distance": by_word,
            }
        )
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` (text, lang), its measures, ``base_failed`` and ``kept``.

    ``keep`` must not hold a name of a measure.
    """
    shared = docs.sparkSession.sparkContext.broadcast(references(docs))
    text = docs.select(*keep, F.col("text").alias("__text"), F.col("lang").alias("__lang"))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = {name: batch.column(name) for name in keep}
                judged = pa.array([lang in shared.value for lang in batch.column("__lang").to_pylist()], pa.bool_())
                yield pa.RecordBatch.from_pydict(own | _measure(batch.column("__text"), shared.value) | {"__judged": judged})

    measured = text.mapInArrow(run, added(docs, keep, f"{MEASURES}, __judged boolean"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    strange = ((F.col("n_words") >= MIN_CLASS_WORDS) & (F.col("class_distance") > CLASS_LIMIT)) | (
        (F.col("n_words") >= MIN_COMMON_WORDS) & (F.col("word_distance") > COMMON_LIMIT)
    )
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~(F.col("__judged") & strange)).drop("__judged")
