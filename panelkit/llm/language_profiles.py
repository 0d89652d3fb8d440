"""Language identification by rank-order profiles.

A text's character n-grams (one to three letters, a space before and after each run of letters) are ordered by
frequency. Its distance from a language is the sum, over its ``TOP`` most frequent n-grams, of how far each is out of its
place in the language's profile; a missing n-gram costs ``TOP``. The nearest language wins.

Profiles are learnt from about ``SAMPLE`` texts of each language (by checksum of the id; the one bound, and a
parameter). n-grams are counted in the tasks and summed by Spark; the driver gets ``TOP`` rows per language.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is everything if there is no profile; ties of
frequency go to the smaller n-gram by code points, ties of distance to the first language by name; rows without
a language are not learnt from; repeated rows are judged each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import added

TOP = 300
SAMPLE = 2_000
UNKNOWN = "und"
PIECE = 1 << 20  # code points handled at once

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """For each code point, whether it is a letter; built once per Python process."""
    global _letters
    if _letters is None:
        points = np.arange(0x110000, dtype="<u4")
        points[0xD800:0xE000] = 32
        _letters = np.fromiter(map(str.isalpha, points.tobytes().decode("utf-32-le")), bool, 0x110000)
    return _letters


def _points(text: str) -> np.ndarray:
    """Lower-case letters of a text as code points, one space for whatever lies between, before and after."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letter = _is_letter()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first that is no letter after a run stands for the gap
    found = np.where(letter, points, 32)[keep]
    return np.concatenate(([32], found, [32] if len(found) and found[-1] != 32 else [])).astype(np.uint64)


def _grams(points: np.ndarray) -> np.ndarray:
    """All n-grams of one to three code points, packed into 21 bits each; none is only a space or spans one."""
    p = points
    shift = np.uint64(21)
    one = p[p != 32]
    two = (p[:-1] << shift) | p[1:]
    inner = p[1:-1] != 32
    three = ((p[:-2] << (shift + shift)) | (p[1:-1] << shift) | p[2:])[inner]
    return np.concatenate((one, two, three))


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order, and how often each occurs; long texts piece by piece."""
    points = _points(text)
    if len(points) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(points) <= PIECE:
        return _tally(_grams(points), None)
    total, low = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 0
    while low < len(points) - 1:  # cut at a space, which both sides keep
        high = low + PIECE
        spaces = np.flatnonzero(points[high:] == 32) if high < len(points) else []
        high = high + int(spaces[0]) if len(spaces) else len(points) - 1
        keys, n = _tally(_grams(points[low : high + 1]), None)
        total = _tally(np.concatenate((total[0], keys)), np.concatenate((total[1], n)))
        low = high
    return total


def _tally(keys: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if n is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.diff(np.append(first, len(keys)))
    keys, back = np.unique(keys, return_inverse=True)
    return keys, np.bincount(back, weights=n).astype(np.int64)


def _top(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, most frequent first; keys come in order, so ties go to the smaller."""
    if len(keys) > TOP:
        least = np.partition(n, len(n) - TOP)[len(n) - TOP]
        at = np.flatnonzero(n >= least)
        keys, n = keys[at], n[at]
    return keys[np.argsort(-n, kind="stable")[:TOP]]


def _count_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            keys, n = _counts(text or "")
            if lang in totals:
                keys, n = np.concatenate((totals[lang][0], keys)), np.concatenate((totals[lang][1], n))
            totals[lang] = _tally(keys, n)
    for lang, (keys, n) in totals.items():
        yield pa.RecordBatch.from_pydict({"lang": [lang] * len(keys), "gram": keys.astype(np.int64), "n": n.astype(np.int64)})


def learn(docs: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Each language's most frequent n-grams in order, from ``docs`` (doc_id, text, lang)."""
    spoken = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r.lang: r["n"] for r in spoken.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))])
    chosen = spoken.where(part < share[F.col("lang")]).select("text", "lang")
    counts = chosen.mapInArrow(_count_parts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TOP).collect()
    profiles: dict[str, np.ndarray] = {}
    for lang in sorted({r.lang for r in rows}):
        mine = sorted((r.place, r.gram) for r in rows if r.lang == lang)
        profiles[lang] = np.array([g for _, g in mine], np.uint64)
    return profiles


def _places(profiles: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the profiles in order, and the place of each in every language (TOP if missing)."""
    grams = np.unique(np.concatenate(list(profiles.values())))
    places = np.full((len(grams) + 1, len(profiles)), TOP, np.int32)  # the last row: in no profile
    for k, own in enumerate(profiles.values()):
        places[np.searchsorted(grams, own), k] = np.arange(len(own))
    return grams, places


def _nearest(text: str | None, grams: np.ndarray, places: np.ndarray) -> tuple[int, float]:
    """The nearest language's number (-1: no letter) and one minus its distance as a share of the largest."""
    own = _top(*_counts(text or ""))
    if not len(own):
        return -1, 0.0
    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
    at = np.where(grams[at] == own, at, len(grams))
    found = places[at]
    out = np.where(found < TOP, np.abs(found - np.arange(len(own))[:, None]), TOP).sum(axis=0)
    best = int(np.argmin(out))
    return best, 1 - float(out[best]) / (TOP * len(own))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` (text), ``lang_pred`` and ``lang_score``."""
    shared = docs.sparkSession.sparkContext.broadcast((list(profiles), _places(profiles) if profiles else None))
    columns = docs.select(*keep, F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, tables = shared.value
        for batch in batches:
            own = {name: batch.column(name) for name in keep}
            texts = batch.column("__text")
            found = [_nearest(texts[i].as_py(), *tables) if tables else (-1, 0.0) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_pydict(
                own
                | {
                    "lang_pred": pa.array([names[k] if k >= 0 else UNKNOWN for k, _ in found], pa.string()),
                    "lang_score": pa.array([s for _, s in found], pa.float64()),
                }
            )

    return columns.mapInArrow(run, added(docs, keep, "lang_pred string, lang_score double"))
