"""Benchmark decontamination with DataFrame functions only.

Texts become words: A-Z lowered, runs of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. The windows of a benchmark item are
its runs of ``WINDOW`` words, or all its words if it has fewer. Hashes of windows go to every task as a hash set, keyed by
the hash of their first two words; the words of the documents are scanned against it, and what
matches is verified word for word. Only these hits, and one short row per document, are shuffled.

The set is broadcast if it has at most ``BROADCAST_WINDOWS`` windows of 24 bytes; a larger benchmark is joined by shuffle.

Defined cases: null and empty texts have no words; items without words have no windows; null item ids count as no
item but their windows are hit; repeated rows get a row each, judged by their own text; other columns are ignored by
``contamination`` and kept by ``remove``; empty tables give empty or clean results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WINDOW = 10
BROADCAST_WINDOWS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, an empty array for null. ``lower`` is exact, and faster, where all is ASCII."""
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.array_remove(F.split(folded, _BETWEEN), ""), F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows: ``window``, its length, hashes of it and of its first two words, the items that hold it."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.lit(WINDOW), F.size("words"))
    cut = items.select("item_id", "words", length.alias("length"), F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("at"))
    windows = cut.select("item_id", F.slice("words", F.col("at"), F.col("length")).alias("window"), "length")
    return windows.groupBy("window", "length").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")).select(
        "window",
        "length",
        "items",
        F.xxhash64("window").alias("hash"),
        F.xxhash64(F.get("window", F.lit(0)), F.get("window", F.lit(1))).alias("head"),
    )


def _scan(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per document (``at`` 0 or null) and one per match by hash (``hash`` not null)."""
    shape = windows.agg(F.count("*").alias("n"), F.coalesce(F.min("length"), F.lit(WINDOW)).alias("least")).first()
    spread = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words")
    ).select("doc_id", "text_hash", "words", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("at", "word"))
    two = F.xxhash64("word", F.get("words", F.col("at") + 1))
    if shape.least == 1:  # an item of one word may begin where any word does
        one = F.xxhash64("word", F.lit(None).cast("string"))
        spread = spread.select("*", F.posexplode(F.array_distinct(F.array(two, one))).alias("kind", "head"))
    else:
        spread = spread.select("*", F.lit(0).alias("kind"), two.alias("head"))
    known = windows.select(F.col("head").alias("known_head"), "length", "hash")
    if shape.n <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
        found = F.slice("words", F.col("at") + 1, F.col("length"))
    else:  # only the words that a window may have are shuffled, not the text's
        spread = spread.withColumn("words", F.slice("words", F.col("at") + 1, F.lit(WINDOW)))
        found = F.slice("words", F.lit(1), F.col("length"))
    matched = spread.join(known, (F.col("head") == F.col("known_head")) & (F.xxhash64(found) == F.col("hash")), "left")
    begins = (F.coalesce("at", F.lit(0)) == 0) & (F.col("kind") == 0)
    return matched.where(begins | F.col("hash").isNotNull()).select(
        "doc_id", "text_hash", "n_words", F.coalesce("at", F.lit(0)).alias("at"), "length", "hash", F.when(F.col("hash").isNotNull(), found).alias("found")
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): how many words it has and how many lie in windows of ``benchmark`` (item_id, text).

    ``text_hash`` tells rows of one id apart.
    """
    windows = written(benchmark_windows(benchmark), "benchmark-windows")
    scanned = written(_scan(docs, windows), "benchmark-matches")
    matches = scanned.where(F.col("hash").isNotNull()).dropDuplicates(["doc_id", "text_hash", "at", "length", "hash"])
    sure = matches.join(windows.select("hash", "window", "items"), "hash").where(F.col("found") == F.col("window"))
    places = F.flatten(F.transform(F.collect_set(F.struct("at", "length")), lambda x: F.sequence(x["at"], x["at"] + x["length"] - 1)))
    hits = sure.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(
        F.size(F.array_distinct(places)).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # a document matched at its first word by several windows has several rows with at = 0
    rows = scanned.where("at = 0").groupBy("doc_id", "text_hash", "n_words", "length", "hash").agg(F.count("*").alias("copies"))
    rows = rows.groupBy("doc_id", "text_hash", "n_words").agg(F.max("copies").alias("copies"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    joined = rows.join(hits, rows.doc_id.eqNullSafe(hits.hit_id) & (rows.text_hash == hits.hit_hash), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "text_hash",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark."""
    bad = contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(bad, docs.doc_id.eqNullSafe(F.col("__id")) & (F.xxhash64(docs.text) == F.col("__hash")), "left_anti")
