"""Phrases whose words keep together, from suffix subtrees that are built group by group.

Texts are cut into pieces at punctuation and line ends, pieces into words. Every word occurrence begins a suffix, cut after ``DEPTH`` words
or at the end of its piece. Vertical partitioning: a prefix of suffixes is one word; one that more than ``BUDGET`` suffixes begin with is
extended to two words, and again to three, where nothing is left to build. Prefixes are ordered by hash, and the hash space is cut where the
sizes add up to a budget: each range is a group that fits a task. Tasks send each group the suffixes of a slice of the corpus as a small
subtree with counts at its leaves, so a prefix that a third of all words begin with is summed before the shuffle. Per group the subtrees become
one, independently of all others; counts of phrases are the totals of the leaves below. What follows (cuts, scores, ranks) is joins.

To the driver come sums of hash ranges (some four per group) and prefixes that exceed the budget: both number at most a few times
words / ``BUDGET``. They are sent to the tasks. A slice makes a row per group that it meets, so with more than some thousands of groups
``budget`` should rise with the executors' memory; a group takes some 100 bytes a suffix.

Words are 64-bit hashes, seeded by language, until the last rows get their texts back.

Defined cases: null and empty texts have no words; a null lang is ``und``; rows count as often as they occur, ids are not read; ties are broken
by phrase; an empty table gives no rows; other columns are ignored; one text of any length is worked off in slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, utf8, written
from .wordscan import mix, run_hashes

DEPTH = 3  # words of the longest phrase
BUDGET = 1_000_000  # suffixes of a group
LEAST = 10  # occurrences of a phrase
COVERED = 50  # percent of a phrase's occurrences in a longer one, from which on it is dropped
TOP = 2000
UNKNOWN = "und"
SLICE = 1 << 20  # suffixes that a task sums up before it sends them
TEXT_CHUNK = 4 * 1024**2

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _BREAK.copy()
_BETWEEN[[0x20, 0x09]] = True
_PAIR = np.uint64(0x9FB21C651E98DF25)


@dataclass
class Words:
    """Words of a chunk: language of each, hash, place in the bytes, and whether the next one follows in the same piece."""

    lang: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    goes_on: np.ndarray


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a phrase and a word after it."""
    return mix(a * _PAIR + b)


def scan(data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, seeds: np.ndarray) -> Words:
    """The words of the rows that the offsets delimit; ``lang`` numbers each row's language."""
    first, last = int(offsets[0]), int(offsets[-1])
    edge = np.zeros(last - first + 1, bool)  # a row begins here
    edge[offsets - first] = True
    part = data[first:last]
    inside = ~_BETWEEN[part]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    breaks = np.cumsum(np.append(_BREAK[part], False) | edge, dtype=np.int32)
    goes_on = np.zeros(len(start), bool)
    goes_on[:-1] = breaks[start[1:]] == breaks[end[:-1] - 1]
    of = lang[np.searchsorted(offsets, start + first, side="right") - 1]
    start, end = start + first, end + first
    return Words(of, mix(run_hashes(data, start, end, folded=True) + seeds[of]), start, end, goes_on)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, Words]]:
    """Languages, bytes and words of chunks of texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        langs = batch.column("lang").dictionary_encode()
        names = langs.dictionary.to_pylist()
        data, offsets = utf8(batch.column("text"))
        numbers, seeds = langs.indices.to_numpy(), np.array([_seed(x) for x in names], np.uint64)
        for low, high in chunks(offsets, TEXT_CHUNK):
            if offsets[high] > offsets[low]:
                yield names, data, scan(data, offsets[low : high + 1], numbers[low:high], seeds)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for names, data, words in _scanned(batches):
        keys, first, n = np.unique(words.hash, return_index=True, return_counts=True)
        text = [data[a:b].tobytes().lower().decode("utf-8") for a, b in zip(words.start[first], words.end[first], strict=True)]
        lang = pa.DictionaryArray.from_arrays(pa.array(words.lang[first], pa.int32()), names).cast(pa.string())
        yield pa.RecordBatch.from_arrays([lang, pa.array(keys.view(np.int64)), pa.array(text, pa.string()), pa.array(n)], ["lang", "hash", "word", "n"])


def _in(keys: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted array."""
    if not len(sorted_):
        return np.zeros(len(keys), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)] == keys


def _followers(hashes: np.ndarray, goes_on: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The three words of each suffix that begins from ``low`` to ``high``; 0 past the end of its piece."""
    one, ahead, goes = hashes[low:high], hashes[low : high + 2], goes_on[low : high + 1]
    two, three = np.zeros_like(one), np.zeros_like(one)
    m = min(len(one), len(ahead) - 1)
    two[:m] = np.where(goes[:m], ahead[1 : m + 1], 0)
    m = min(len(one), len(ahead) - 2)
    if m > 0:
        three[:m] = np.where(goes[:m] & goes[1 : m + 1], ahead[2 : m + 2], 0)
    return one, two, three


def _summed(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    keys, first, n = np.unique(keys, return_index=True, return_counts=True)
    return keys, *[c[first] for c in columns], n


@dataclass
class Partition:
    """Words and pairs of words that too many suffixes begin with, and the upper ends of the groups' hash ranges."""

    words: np.ndarray
    pairs: np.ndarray
    ends: np.ndarray

    def prefix(self, one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
        out = one.copy()
        long = np.flatnonzero(_in(one, self.words))
        out[long] = pair(one[long], two[long])
        long = long[_in(out[long], self.pairs)]
        out[long] = pair(out[long], three[long])
        return out

    def group(self, prefix: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, prefix)


def _prefix_counts(shared, depth: int):
    """Counts of the prefixes of ``depth`` words that begin with one which exceeds the budget."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Partition = shared.value
        for names, _, words in _scanned(batches):
            for low in range(0, len(words.hash), SLICE):
                one, two, three = _followers(words.hash, words.goes_on, low, low + SLICE)
                lang = words.lang[low : low + SLICE]
                at = np.flatnonzero(_in(one, known.words))
                if depth == 3:
                    at = at[_in(pair(one[at], two[at]), known.pairs)]
                if len(at):
                    prefix = pair(one[at], two[at])
                    prefix = pair(prefix, three[at]) if depth == 3 else prefix
                    prefix, a, b, l, n = _summed(prefix, one[at], two[at], lang[at])
                    of = pa.DictionaryArray.from_arrays(pa.array(l, pa.int32()), names).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([of, *[pa.array(x.view(np.int64)) for x in (prefix, a, b)], pa.array(n)], ["lang", "prefix", "one", "two", "n"])

    return run


def _partition(texts: DataFrame, words: DataFrame, total: int, budget: int) -> tuple[Partition, DataFrame | None]:
    """The groups, and the table of two-word prefixes of words that exceed the budget (lang, prefix, one, two, n)."""
    context = texts.sparkSession.sparkContext
    known = Partition(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    sizes, pairs = words.select(F.col("hash").alias("prefix"), "n"), None
    known.words = _hashes(sizes.where(F.col("n") > budget))
    if len(known.words):
        schema = "lang string, prefix long, one long, two long, n long"
        counted = texts.mapInArrow(_prefix_counts(context.broadcast(known), 2), schema).groupBy("lang", "prefix", "one", "two").agg(F.sum("n").alias("n"))
        pairs = written(counted, "phrases-pairs")
        known.pairs = _hashes(pairs.where(F.col("n") > budget).select("prefix"))
        sizes = sizes.where(F.col("n") <= budget).union(pairs.where(F.col("n") <= budget).select("prefix", "n"))
        if len(known.pairs):
            triples = texts.mapInArrow(_prefix_counts(context.broadcast(known), 3), schema).groupBy("prefix").agg(F.sum("n").alias("n"))
            sizes = sizes.union(triples)
    bits = max(6, int(4 * total / budget).bit_length())
    # hashes as the unsigned numbers that they stand for: the upper bits number ranges of equal width
    ranges = sizes.groupBy(F.shiftrightunsigned("prefix", 64 - bits).alias("range")).agg(F.sum("n").alias("n")).collect()
    ends, size = [], 0
    for r in sorted(ranges, key=lambda r: r.range):
        if size and size + r.n > budget:
            ends.append((r.range << (64 - bits)) - 1)
            size = 0
        size += r.n
    known.ends = np.array(ends, np.uint64)
    return known, pairs


def _hashes(rows: DataFrame) -> np.ndarray:
    return np.sort(np.array([r[0] for r in rows.collect()], np.int64).view(np.uint64))


def _edges(*sorted_: np.ndarray) -> np.ndarray:
    """Where a row of the given columns differs from the one before it."""
    out = np.zeros(len(sorted_[0]), bool)
    out[:1] = True
    for c in sorted_:
        out[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(out)


def _subtree(one: np.ndarray, two: np.ndarray, three: np.ndarray, n: np.ndarray) -> bytes:
    """Leaves in order, level by level: each level's words, then how many children each node has, or its count."""
    e1, e2 = _edges(one), _edges(one, two)
    head = np.array([len(e1), len(e2), len(three)], np.uint32)
    first = np.searchsorted(e2, np.append(e1, len(one)))
    levels = [one[e1], two[e2], three], [np.diff(first), np.diff(np.append(e2, len(three))), n]
    return b"".join([head.tobytes(), *[x.tobytes() for x in levels[0]], *[x.astype(np.uint32).tobytes() for x in levels[1]]])


def _leaves(tree: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.frombuffer(tree, np.uint32, 3)
    at, words, counts = 12, [], []
    for size in sizes:
        words.append(np.frombuffer(tree, np.uint64, size, at))
        at += 8 * int(size)
    for size in sizes:
        counts.append(np.frombuffer(tree, np.uint32, size, at))
        at += 4 * int(size)
    two = np.repeat(words[1], counts[1])
    one = np.repeat(np.repeat(words[0], counts[0]), counts[1])
    return one, two, words[2], counts[2].astype(np.int64)


def _subtrees(shared):
    """Per slice of suffixes, language and group: the subtree of its leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Partition = shared.value
        for names, _, words in _scanned(batches):
            for low in range(0, len(words.hash), SLICE):
                # numbers for words, so that a leaf sorts as one number; 0 is the end of a piece
                own, number = np.unique(words.hash[low : low + SLICE + DEPTH - 1], return_inverse=True)
                one, two, three = _followers(number.astype(np.uint64) + np.uint64(1), words.goes_on[low:], 0, min(SLICE, len(words.hash) - low))
                width = np.uint64((len(own) + 1).bit_length())
                leaf, first, n = np.unique((one << (width + width)) | (two << width) | three, return_index=True, return_counts=True)
                own = np.append(np.zeros(1, np.uint64), own)
                one, two, three = own[one[first]], own[two[first]], own[three[first]]
                lang = words.lang[low + first].astype(np.int64)
                group = known.group(known.prefix(one, two, three))
                by = group * len(names) + lang
                by = np.argsort(by.astype(np.uint16) if by.max() < 65536 else by, kind="stable")
                group, lang, one, two, three, n = (x[by] for x in (group, lang, one, two, three, n))
                cut = np.append(_edges(group, lang), len(group))
                trees = [_subtree(one[a:b], two[a:b], three[a:b], n[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                of = pa.DictionaryArray.from_arrays(pa.array(lang[cut[:-1]], pa.int32()), names).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(group[cut[:-1]]), of, pa.array(trees, pa.binary())], ["group", "lang", "tree"])

    return run


PHRASES = "lang string, one long, two long, three long, a long, left_1 long, left_2 long, first_pair long, last_pair long"

PHRASE_NAMES = [f.split()[0] for f in PHRASES.split(", ")]


def _phrases(shared, hot, least: int):
    """One group: its subtrees become one, whose nodes with enough leaves below are phrases."""

    def run(key: tuple, trees: pa.Table) -> pa.Table:
        known: Partition = shared.value
        totals = hot.value
        parts = [_leaves(t) for t in trees.column("tree").to_pylist()]
        one, two, three, n = (np.concatenate([p[k] for p in parts]) for k in range(4))
        del parts
        _, by = np.unique(one, return_inverse=True)
        below = np.bincount(by, weights=n).astype(np.int64)[by]  # leaves below the first word
        double, node = np.unique(pair(one, two), return_inverse=True)
        total = np.bincount(node, weights=n).astype(np.int64)
        keep = np.flatnonzero((total[node] >= least) & (two != 0))
        one, two, three, n, below, node = one[keep], two[keep], three[keep], n[keep], below[keep], node[keep]
        extended = _in(one, known.words)
        below[extended] = [totals[x] for x in one[extended].tolist()]
        # a pair that is itself too frequent lies in several groups: its total is known, and it is no phrase of this group
        split = _in(double[node], known.pairs)
        pairs = total[node]
        pairs[split] = [totals[x] for x in double[node[split]].tolist()]
        by = np.lexsort((three, node))
        one, two, three, n, below, pairs, node, split = (x[by] for x in (one, two, three, n, below, pairs, node, split))
        leaf = _edges(node, three)
        a = np.add.reduceat(n, leaf) if len(leaf) else n
        long = leaf[(a >= least) & (three[leaf] != 0)]
        a = a[(a >= least) & (three[leaf] != 0)]
        short = _edges(node)
        short = short[~split[short]]
        rows = [np.concatenate(x) for x in (
            (one[short], one[long]), (two[short], two[long]), (np.zeros(len(short), np.uint64), three[long]),
            (pairs[short], a), (below[short], below[long]), (np.zeros(len(short), np.int64), pairs[long]),
            (double[node[short]], double[node[long]]), (np.zeros(len(short), np.uint64), pair(two[long], three[long])),
        )]
        lang = pa.array([key[1].as_py()] * len(rows[0]), pa.string())
        return pa.Table.from_arrays([lang, *[pa.array(x.view(np.int64)) for x in rows]], PHRASE_NAMES)

    return run


def phrases(docs: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Counts of words (lang, hash, word, n), and of phrases of 2 and 3 words that occur ``least`` times or more.

    Phrases have the hashes of their words (``three`` 0 if there is none), ``a`` occurrences, ``left_1`` of their first word, ``left_2`` of their
    first two, and the hashes of their first and last two words.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    counted = texts.mapInArrow(_word_counts, "lang string, hash long, word string, n long")
    words = written(counted.groupBy("lang", "hash", "word").agg(F.sum("n").alias("n")), "phrases-words")
    total = words.agg(F.sum("n")).first()[0] or 0
    known, pairs = _partition(texts, words, total, budget)
    hot = {r.hash & (2**64 - 1): r.n for r in words.where(F.col("n") > budget).select("hash", "n").collect()}
    if pairs is not None:
        hot |= {r.prefix & (2**64 - 1): r.n for r in pairs.where(F.col("n") > budget).select("prefix", "n").collect()}
    shared, totals = context.broadcast(known), context.broadcast(hot)
    trees = texts.mapInArrow(_subtrees(shared), "group long, lang string, tree binary")
    found = trees.groupBy("group", "lang").applyInArrow(_phrases(shared, totals, least), PHRASES)
    if pairs is not None:  # pairs that lie in several groups
        wide = pairs.where((F.col("n") > budget) & (F.col("two") != 0)).join(words.select(F.col("hash").alias("one"), F.col("n").alias("left_1")), "one")
        zero = F.lit(0).cast("long")
        found = found.union(wide.select("lang", "one", "two", zero.alias("three"), F.col("n").alias("a"), "left_1", zero.alias("left_2"), F.col("prefix").alias("first_pair"), zero.alias("last_pair")))
    return words, written(found, "phrases")


def _first(phrases: DataFrame, by: str, top: int) -> DataFrame:
    """Each language's phrases down to the value of ``by`` that has the ``top``-th, all of that value included.

    Only counts of values are ordered: scores are at most 1,000,001, and sixteenths of octaves of ``a`` a few hundred. ``octave`` compares phrases
    of the lowest score that is left; ``before`` counts those above it.
    """
    if by == "octave":
        lowest = phrases.groupBy("lang").agg(F.min("score").alias("lowest"))
        octave = F.when(F.col("score") > F.col("lowest"), F.lit(1 << 20)).otherwise(F.floor(16 * F.log2(F.col("a"))).cast("int"))
        phrases = phrases.drop("before").join(lowest, "lang").withColumn("octave", octave).drop("lowest")
    counts = phrases.groupBy("lang", by).agg(F.count("*").alias("phrases"))
    above = Window.partitionBy("lang").orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("phrases").over(above), F.lit(0))).where(F.col("before") < top).drop("phrases")
    return phrases.join(counts, ["lang", by])


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, covered: int = COVERED, budget: int = BUDGET) -> DataFrame:
    """Each language's ``top`` phrases by score (docs: text, lang): lang, rank, phrase, a, l, r, n, score.

    ``l`` and ``r`` count the two parts of a phrase at the cut with the lowest score, floor(1,000,000 a a / (l r)); ``n`` counts all words.
    A phrase is dropped if ``covered`` percent of its occurrences lie in one longer phrase.
    """
    words, found = phrases(docs, least, budget)
    short = found.where("three = 0")
    parts = words.where(F.col("n") >= least).select(F.col("hash").alias("key"), F.col("n").alias("r"))
    parts = parts.union(short.select(F.col("first_pair").alias("key"), F.col("a").alias("r")))
    cut = F.when(
        F.col("three") == 0, F.array(F.struct(F.lit(1).alias("k"), F.col("left_1").alias("l"), F.col("two").alias("key")))
    ).otherwise(
        F.array(
            F.struct(F.lit(1).alias("k"), F.col("left_1").alias("l"), F.col("last_pair").alias("key")),
            F.struct(F.lit(2).alias("k"), F.col("left_2").alias("l"), F.col("three").alias("key")),
        )
    )
    phrase = ["lang", "one", "two", "three", "a", "first_pair"]
    wide = "decimal(38,0)"
    square = F.col("a").cast("decimal(19,0)") * F.col("a").cast("decimal(19,0)")
    score = F.expr(f"cast(cast(square * 1000000 as {wide}) div cast(cast(l as decimal(19,0)) * cast(r as decimal(19,0)) as {wide}) as long)")
    cuts = found.select(*phrase, square.cast(wide).alias("square"), F.inline(cut)).join(parts, "key")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    scored = cuts.groupBy(*phrase).agg(lowest.alias("cut")).select(*phrase, "cut.score", "cut.l", "cut.r")
    longer = found.where("three <> 0").select(F.explode(F.array("first_pair", "last_pair")).alias("first_pair"), F.col("a").alias("longer"))
    longer = longer.groupBy("first_pair").agg(F.max("longer").alias("longer")).withColumn("three", F.lit(0).cast("long"))
    kept = scored.join(longer, ["first_pair", "three"], "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    kept = written(kept.drop("longer", "first_pair"), "phrases-scored")
    best = written(_first(_first(kept, "score", top), "octave", top).drop("octave", "before"), "phrases-best")
    text = words.where(F.col("n") >= least)
    for k in ("one", "two", "three"):
        best = best.join(text.select(F.col("hash").alias(k), F.col("word").alias(f"word_{k}")), k, "left")
    sums = words.groupBy("lang").agg(F.sum("n").alias("n"))
    named = best.select("lang", F.concat_ws(" ", "word_one", "word_two", "word_three").alias("phrase"), "a", "l", "r", "score").join(sums, "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return named.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
