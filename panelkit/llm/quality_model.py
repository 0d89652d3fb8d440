"""Quality classifier: logistic regression over hashed word n-grams, fitted with FTRL-proximal updates.

Features are shares of a text: word unigrams and bigrams (A-Z folded), and unigrams, bigrams and trigrams of
word shapes. A shape says which kinds of characters a word holds and whether it repeats the word before
it. All are hashed into ``BUCKETS`` weights; a score is the logistic of a sparse dot product.

Fitting: a sample of about ``SAMPLE`` labelled rows of each class (by checksum of the id; the one bound here,
and a parameter) is cut into ``SHARDS``. In each of ``ROUNDS`` rounds every shard runs FTRL over its rows from the common
state, and the states are averaged by Spark. The state has at most ``BUCKETS`` entries.

Defined cases: null and empty texts have no features and get the score of the bias alone; labels that are
null are not learnt from, and of contradicting labels of an id the larger counts; ids that repeat in the
documents are all learnt from; without labels of both classes every score is the smoothed share of label 1
(0.5 without any). An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import added, chunks, utf8, written
from .wordscan import Runs, mix, runs

BUCKETS = 1 << 18
SAMPLE = 10_000
SHARDS = 8
ROUNDS = 3
ACCEPT = 0.7

ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.0005, 0.0001
PASSES = 2  # over a shard's rows in a round


def _kind_table() -> np.ndarray:
    """A bit for each kind of character; each symbol of the first row has its own."""
    bits = np.zeros(256, np.uint32)
    bits[97:123], bits[65:91], bits[48:58] = 1, 2, 4
    bits[128:] = 8
    for i, c in enumerate(b".,!?:;|#*$%&<>@/_-'\"()=+"):
        bits[c] = 16 << i
    return bits


_KINDS = _kind_table()


def _buckets(words: Runs, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and buckets of the features, one entry per occurrence."""
    if not len(words.row):
        return
    row, h = words.row, words.hash
    # white space has no kind, so it adds nothing to the word before it
    kinds = np.bitwise_or.reduceat(_KINDS[data[words.start[0] : words.end[-1]]], words.start - words.start[0])
    again = np.zeros(len(row), np.uint64)
    again[1:] = (row[1:] == row[:-1]) & (h[1:] == h[:-1])
    shape = mix(kinds.astype(np.uint64) * np.uint64(2) + again + np.uint64(1 << 40))
    prime = np.uint64(0x9E3779B97F4A7C15)
    mask = np.uint64(BUCKETS - 1)
    same = row[1:] == row[:-1]
    both = same[1:] & same[:-1]
    two = shape[:-1] * prime + shape[1:]
    yield row, h & mask
    yield row[1:][same], (mix(h[:-1] * prime + h[1:]) & mask)[same]
    yield row, shape & mask
    yield row[1:][same], (mix(two) & mask)[same]
    yield row[2:][both], (mix(two[:-1] * prime + shape[2:]) & mask)[both]


def _features(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted buckets and their shares, for each text."""
    data, offsets = utf8(text)
    for low, high in chunks(offsets):
        words = runs(data, offsets[low : high + 1], folded=True)
        parts = [(r * BUCKETS + b.astype(np.int64)) for r, b in _buckets(words, data)]
        key, count = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.int64),) * 2
        at = np.searchsorted(key, np.arange(words.rows + 1) * BUCKETS)
        n = words.per_row()
        for i in range(words.rows):
            own = slice(at[i], at[i + 1])
            yield (key[own] % BUCKETS).astype(np.int32), count[own] / max(n[i], 1)


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """FTRL-proximal passes in place; the last entry of the state is the bias, without L1."""

    def weights(i: np.ndarray) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    for _ in range(PASSES):
        for bucket, value, label in rows:
            i = np.append(bucket, BUCKETS)
            x = np.append(value, 1.0)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w).astype(np.float32)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found = list(_features(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([b for b, _ in found], pa.list_(pa.int32())),
                    pa.array([v for _, v in found], pa.list_(pa.float64())),
                ],
                ["doc_id", "label", "bucket", "share"],
            )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the buckets and, last, the bias. ``docs`` has doc_id and text, ``labels`` doc_id and label (0 or 1)."""
    spark = docs.sparkSession
    labels = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    labels = labels.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    counts = {r.label: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return np.append(np.zeros(BUCKETS, np.float32), np.float32(np.log(share / (1 - share))))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    chosen = labels.where(
        part < F.when(F.col("label") == 1, min(1.0, sample / counts[1])).otherwise(min(1.0, sample / counts[0]))
    )
    # about 2 x sample ids of 12 bytes: bounded, so they may be sent to every task
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.mapInArrow(_feature_rows, "doc_id long, label int, bucket array<int>, share array<double>")
    rows = written(rows.withColumn("shard", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(SHARDS))), "classifier-rows")

    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for _ in range(ROUNDS):
        state = spark.sparkContext.broadcast((z, n))

        def train(shard: pd.DataFrame) -> pd.DataFrame:
            z, n = (x.copy() for x in state.value)
            shard = shard.sort_values("doc_id", kind="stable")
            order = np.random.Generator(np.random.PCG64(7)).permutation(len(shard))
            buckets, shares, labels = shard["bucket"].array, shard["share"].array, shard["label"].array
            _ftrl([(np.asarray(buckets[i]), np.asarray(shares[i]), labels[i]) for i in order], z, n)
            at = np.flatnonzero(n)
            return pd.DataFrame({"bucket": at.astype(np.int32), "z": z[at], "n": n[at]})

        states = rows.groupBy("shard").applyInPandas(train, "bucket int, z double, n double")
        shards = rows.select("shard").distinct().count()
        merged = states.groupBy("bucket").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toPandas()
        z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
        z[merged["bucket"]], n[merged["bucket"]] = merged["z"] / shards, merged["n"] / shards
    return _weights(z, n)


def _scores(text: pa.Array, weights: np.ndarray) -> np.ndarray:
    data, offsets = utf8(text)
    out = []
    for low, high in chunks(offsets):
        words = runs(data, offsets[low : high + 1], folded=True)
        total = np.zeros(words.rows)
        for row, bucket in _buckets(words, data):
            total += np.bincount(row, weights=weights[bucket.astype(np.int64)], minlength=words.rows)
        logit = total / np.maximum(words.per_row(), 1) + weights[BUCKETS]
        out.append(1 / (1 + np.exp(-np.clip(logit, -35, 35))))
    return np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, weights: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` (text) and its ``quality_score``, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    columns = docs.select(*keep, F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = {name: batch.column(name) for name in keep}
                yield pa.RecordBatch.from_pydict(own | {"quality_score": _scores(batch.column("__text"), shared.value)})

    return columns.mapInArrow(run, added(docs, keep, "quality_score double"))
