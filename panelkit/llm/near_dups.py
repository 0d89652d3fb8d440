"""Near duplicates by MinHash: banded candidates, sequential Bayesian pruning, exact verification.

A document's set is its distinct shingles of five words (A-Z folded; a shorter text is one shingle). Documents are linked
if ``100 * intersection >= percent * union`` of their sets.

1. Documents of the same set are one class, and its smallest id stands for it; classes are summed before the shuffle.
2. Signatures put the classes into buckets: ``BANDS`` bands of as many values as let two of the least similarity miss all with a chance
   of ``MISSED`` at most (7 at 85 percent: 4e-6; 5 at 80: 3e-6).
3. Of the texts that share a bucket, each counts its shingles that none of the others has. These bound its similarity to
   any of them, without any pair: a text that is too much its own is out, and so are pairs of such texts.
4. In each bucket the members are compared with the one that has the least of its own; links make components. Members that
   are then in another component than that one are compared with all members of yet another component, unless what both
   lack of that one's set rules it out (as bits of the lacking shingles, which can only count too few). What lies in one
   component needs no comparison, so a large group of near copies costs a comparison per member, not per pair.
5. A pair is compared by its signatures first, ``BATCH`` values at a time: it is dropped as soon as the
   posterior chance of the similarity being high enough, with a flat prior, is under ``MISS``. Survivors are verified on
   their full sets, from the texts.

Links, classes and components stay in tables. Defined cases: null and empty texts, and texts without words, have an empty set and
are linked with nothing; rows that repeat an id are one node, linked if one of its texts is; rows without an id are
linked with nothing and kept; ties do not arise; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, utf8, written
from .components import components
from .wordscan import Runs, keyed, mix, runs, windows

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 32, 7  # rows at most
MISSED = 5e-6
KEPT = 128  # signature values kept for the pruning, 16 bits of each
BATCH = 32
MISS = 1e-7
BITS = 1 << 24

_MULTIPLIERS = (np.random.Generator(np.random.PCG64(85)).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) << 1) | 1
_SCRAMBLE = np.random.Generator(np.random.PCG64(86)).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def _shingles(words: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every shingle, rows in order."""
    at, hashes = windows(words, SHINGLE)
    row = words.row[at]
    n = words.per_row()
    for length in range(1, SHINGLE):  # the whole of a shorter text
        if (n == length).any():
            few, h = windows(words, length)
            own = n[words.row[few]] == length
            row, hashes = np.concatenate((row, words.row[few][own])), np.concatenate((hashes, h[own] + np.uint64(length)))
    order = np.argsort(row, kind="stable")
    return row[order], hashes[order]


def _rows(percent: int) -> int:
    """How many values a band has for a least similarity."""
    return max(r for r in range(1, ROWS + 1) if r == 1 or (1 - (percent / 100) ** r) ** BANDS <= MISSED)


def _signatures(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and their signatures."""
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first), BANDS * ROWS), np.uint32)
    for i, m in enumerate(_MULTIPLIERS):
        value = low * m
        value += high
        out[:, i] = np.minimum.reduceat(value, first)
    return row[first], out


def _distinct(row: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Row and hash of each distinct shingle, size of each set, and two marks of it: sums that no order changes."""
    _, one = np.unique(keyed(row, hashes), return_index=True)
    row, hashes = row[one], hashes[one]
    marks = [np.zeros(rows, np.uint64) for _ in range(2)]
    for mark, salt in zip(marks, (0x51, 0xA7), strict=True):
        np.add.at(mark, row, mix(hashes ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)))
    return row, hashes, np.bincount(row, minlength=rows), marks


def _set_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for low, high in chunks(offsets, 1 << 19):
            words = runs(data, offsets[low : high + 1], folded=True)
            row, hashes = _shingles(words)
            _, _, size, marks = _distinct(row, hashes, high - low)
            bands: list = [None] * (high - low)
            kept: list = [None] * (high - low)
            if len(row):
                own, signature = _signatures(row, hashes)
                wide = (signature.astype(np.uint64) * _SCRAMBLE)[:, : BANDS * rows].reshape(len(own), BANDS, rows)
                keys = mix(np.bitwise_xor.reduce(mix(wide), axis=2) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                short = signature[:, :KEPT].astype(np.uint16)
                for i, r in enumerate(own):
                    bands[r], kept[r] = keys[i], short[i].tobytes()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").slice(low, high - low),
                    "n": size.astype(np.int64),
                    "mark_a": marks[0].view(np.int64),
                    "mark_b": marks[1].view(np.int64),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                    "kept": pa.array(kept, pa.binary()),
                }
            )


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per distinct shingle of each text."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        ids = batch.column("doc_id").to_numpy()
        for low, high in chunks(offsets):
            row, hashes = _shingles(runs(data, offsets[low : high + 1], folded=True))
            row, hashes, _, marks = _distinct(row, hashes, high - low)
            yield pa.RecordBatch.from_pydict({"node": ids[low + row], "mark_a": marks[0].view(np.int64)[row], "shingle": hashes.view(np.int64)})


def _least_matches(percent: int = PERCENT) -> list[int]:
    """For each batch: the fewest matches so far that leave a chance of MISS for a similarity of ``percent`` or more.

    With a flat prior the posterior is a Beta distribution; its tail is a sum of binomial terms.
    """
    t, out = percent / 100, []
    for n in range(BATCH, KEPT + 1, BATCH):
        tail, m = 0.0, -1
        while tail < MISS:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def _prune(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    least = _least_matches(percent)
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, KEPT) for c in ("kept_x", "kept_y"))
        alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
        for i, need in enumerate(least):
            part = slice(i * BATCH, (i + 1) * BATCH)
            matches[alive] += (x[alive, part] == y[alive, part]).sum(axis=1)
            alive = alive[matches[alive] >= need]
        yield batch.select(["x", "y"]).take(pa.array(alive))


def _similar(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that the signatures do not rule out."""
    kept = classes.select("node", "kept")
    both = pairs.join(kept.toDF("x", "kept_x"), "x").join(kept.toDF("y", "kept_y"), "y")
    return both.select("x", "y", "kept_x", "kept_y").mapInArrow(partial(_prune, percent=percent), "x long, y long").distinct()


def _compare(a: np.ndarray, b: np.ndarray, percent: int) -> tuple[bool, int, int, int]:
    """Whether two sets are linked, how many shingles they share, and what of the first the second lacks, as 128 bits."""
    lack = a[~np.isin(a, b, assume_unique=True)]
    shared = len(a) - len(lack)
    bits = np.zeros(128, np.uint8)
    bits[(lack % np.uint64(128)).astype(np.int64)] = 1
    one, two = np.packbits(bits).view(np.int64).tolist()
    return 100 * shared >= percent * (len(a) + len(b) - shared), shared, one, two


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    recent: OrderedDict[tuple[int, int], np.ndarray] = OrderedDict()  # sets of the last texts, which often come again

    def sets(texts: list[str]) -> list[np.ndarray]:
        new = [t for t in dict.fromkeys(texts) if t not in recent]
        data, offsets = utf8(pa.array(new, pa.large_string()))
        for low, high in chunks(offsets):
            row, hashes = _shingles(runs(data, offsets[low : high + 1], folded=True))
            cut = np.searchsorted(row, np.arange(high - low + 1))
            for i in range(high - low):
                recent[new[low + i]] = np.unique(hashes[cut[i] : cut[i + 1]])
        found = [recent[t] for t in texts]
        while len(recent) > 64:
            recent.popitem(last=False)
        return found

    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            part = batch.slice(low, 64)
            n = part.num_rows
            found = sets(part.column("text_x").to_pylist() + part.column("text_y").to_pylist())
            rows = [_compare(found[i], found[n + i], percent) for i in range(n)]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.bool_(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([part.column("x"), part.column("y"), *columns], ["a", "b", "linked", "common", "lack_1", "lack_2"])


def _compared(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) as a and b, with what ``_compare`` says of their full sets. ``texts`` has doc_id and text."""
    both = pairs.join(texts.toDF("y", "text_y"), "y").join(texts.toDF("x", "text_x"), "x")
    return both.select("x", "y", "text_x", "text_y").mapInArrow(partial(_verify, percent=percent), "a long, b long, linked boolean, common long, lack_1 long, lack_2 long")


def _close(percent: int, n: str, own_n: str, m: str, own_m: str) -> Column:
    """Whether two sets of n and m may be similar enough, if own_n and own_m of them are in no other set."""
    n, own_n, m, own_m = (F.col(x) for x in (n, own_n, m, own_m))
    return 100 * F.least(n - own_n, m - own_m) >= percent * (F.greatest(n - own_n, m - own_m) + own_n + own_m)


def _close_by_leader(percent: int) -> Column:
    """Whether two sets may be similar enough, by how each compares with their leader's; true where that is not known.

    They share at most what neither lacks of the leader's, and what both have besides that is not their own.
    """
    lacked = F.bit_count(F.col("lack_1_x").bitwiseOR(F.col("lack_1_y"))) + F.bit_count(F.col("lack_2_x").bitwiseOR(F.col("lack_2_y")))
    besides = F.least(*[F.greatest(F.lit(0), F.col(f"n_{s}") - F.col(f"common_{s}") - F.col(f"own_{s}")) for s in "xy"])
    most = F.col("leader_n") - lacked + besides
    return F.coalesce(100 * most >= percent * (F.col("n_x") + F.col("n_y") - most), F.lit(True))


def _likely(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose column may be an id of ``ids``, before an exact join: few others pass while the ids are few.

    The ids are marked in ``BITS`` bits by hash, 64 to a row: a broadcast of fixed size, however many there are.
    """
    place = f"pmod(xxhash64({{}}), {BITS}L)"
    marked = ids.selectExpr(f"{place.format('id')} AS place").groupBy(F.expr("place div 64 AS word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place % 64 AS int)))").alias("bits")
    )
    placed = df.withColumn("place", F.expr(place.format(column)))
    joined = placed.join(F.broadcast(marked), F.expr("place div 64") == F.col("word"))
    return joined.where("bits & shiftleft(1L, cast(place % 64 AS int)) != 0").select(df.columns)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text), with links from a similarity of ``percent`` on: n_shingles, component_id (smallest id reachable by links) and kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = written(docs.mapInArrow(partial(_set_rows, rows=_rows(percent)), "doc_id long, n long, mark_a long, mark_b long, bands array<long>, kept binary"), "shingle-sets")
    first = F.min(F.struct("doc_id", "bands", "kept")).alias("first")
    classes = sets.where("n > 0 and doc_id is not null").groupBy("mark_a", "mark_b", "n").agg(first)
    classes = written(classes.select("mark_a", "mark_b", "n", F.col("first.doc_id").alias("node"), "first.bands", "first.kept"), "classes")

    # what shares a bucket, and how much of it is in no other text that does
    cast = classes.select("node", "mark_a", F.explode("bands").alias("bucket"))
    shared = cast.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    candidates = written(cast.join(shared, "bucket").select("node", "mark_a").distinct(), "candidates")
    ids = candidates.select(F.col("node").alias("id")).distinct()
    # ids are distinct; a semi join would be pushed below the filter by bits
    texts = _likely(docs, "doc_id", ids).join(ids.toDF("doc_id"), "doc_id")
    texts = written(texts.distinct(), "candidate-texts")
    shingles = texts.mapInArrow(_shingle_rows, "node long, mark_a long, shingle long")
    lone = shingles.groupBy("shingle").agg(F.count("*").alias("n"), F.first("node").alias("node"), F.first("mark_a").alias("mark_a")).where("n = 1")
    lone = lone.groupBy("node", "mark_a").agg(F.count("*").alias("own"))
    live = _likely(classes, "node", ids).join(candidates, ["node", "mark_a"]).join(lone, ["node", "mark_a"], "left").na.fill(0, ["own"])
    live = written(live.where(100 * (F.col("n") - F.col("own")) >= percent * F.col("n")), "live-classes")

    members = live.select("node", "n", "own", F.explode("bands").alias("bucket"))
    leader = F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "node", "n", "own")).alias("leader")
    buckets = members.groupBy("bucket").agg(leader, F.count("*").alias("size")).where("size > 1")
    members = members.join(buckets, "bucket").select(
        "bucket", "node", "n", "own", F.col("leader.node").alias("leader"), F.col("leader.n").alias("leader_n"), F.col("leader.own").alias("leader_own")
    )
    members = written(members, "buckets")

    stars = members.where((F.col("node") != F.col("leader")) & _close(percent, "n", "own", "leader_n", "leader_own"))
    stars = stars.select(F.col("leader").alias("x"), F.col("node").alias("y")).distinct()
    stars = written(_compared(_similar(stars, live, percent), texts, percent), "star-pairs")
    nodes = classes.select("mark_a", "mark_b", "n", "node")
    # an id with several texts is one node: it links their classes
    own = sets.where("n > 0 and doc_id is not null").select("doc_id", "mark_a", "mark_b", "n")
    mark = F.struct("mark_a", "mark_b", "n")
    several = own.groupBy("doc_id").agg(F.min(mark).alias("least"), F.max(mark).alias("most")).where("least != most").select("doc_id")
    ties = own.join(several, "doc_id", "left_semi").join(nodes, ["mark_a", "mark_b", "n"]).where("doc_id != node")
    links = written(stars.where("linked").select("a", "b").union(ties.select("doc_id", "node")), "first-links")
    found = written(components(links), "components")

    # members whose component is not that of their bucket's leader, against all others of yet another
    led = members.join(found, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    led = led.join(found.toDF("leader", "component"), "leader", "left").withColumn("lead", F.coalesce("component", "leader"))
    # of an id with several texts it is not known whose figures these are
    figures = [F.when(F.count("*") == 1, F.first(c)).alias(c) for c in ("common", "lack_1", "lack_2")]
    to_leader = stars.groupBy("a", "b").agg(*figures)
    led = led.join(to_leader.withColumnsRenamed({"a": "leader", "b": "node"}), ["leader", "node"], "left").where("node != leader")
    apart = ["node", "part", "n", "own", "common", "lack_1", "lack_2"]
    strays = led.where("part != lead").select("bucket", *[F.col(c).alias(f"{c}_x") for c in apart])
    others = led.select("bucket", "lead", "leader_n", *[F.col(c).alias(f"{c}_y") for c in apart])
    across = strays.join(others, "bucket").where(
        (F.col("part_x") != F.col("part_y"))
        & ((F.col("part_y") == F.col("lead")) | (F.col("node_x") < F.col("node_y")))  # both strays: once
        & _close(percent, "n_x", "own_x", "n_y", "own_y")
        & _close_by_leader(percent)
    )
    across = across.select(F.least("node_x", "node_y").alias("x"), F.greatest("node_x", "node_y").alias("y")).distinct()
    more = written(_compared(_similar(across, live, percent), texts, percent), "cross-pairs").where("linked").select("a", "b")
    if more.take(1):
        found = written(components(links.union(more)), "components")

    rows = sets.drop("bands", "kept").join(nodes, ["mark_a", "mark_b", "n"], "left").join(found, "node", "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "node"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )
