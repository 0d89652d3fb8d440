"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax, n-grams of all words, and a smoothed unigram base.

Tokens are words (A-Z folded, by hash) and one end per text. The softmax, whose features know the commonest tokens only, says
    P(token | history) = P(class | history) * P(token | class, history).
The ``HEAD`` most frequent tokens (the end always among them) are cut by rank into classes of ``WORDS``; any other token belongs to one of
``TAILS`` classes by its spelling: its last two bytes, and whether it goes beyond ASCII. The first factor, and the second in head classes,
are softmaxes over summed weights of the history's features: the last token, the two before it skipped to, and the hashed last
two. In a tail class the second factor is the smoothed share of the token's count. Both factors sum to one over all
tokens, unseen ones included (one per tail class).

N-grams of word ids, as many as the training texts have, then move this share for every token, in head and tail: for each of the histories
``FAMILIES`` (three back, two back, the last, the last two), in this order,
    P(token | history) = (n(history, token) + m * P before(token | history)) / (n(history) + m),
where P before is what the family before it says, so the sum over all tokens stays one. Each training block
has four m that make it likeliest if none of its tokens counts for itself; the model's are the means of their logarithms over all training tokens.

1. Texts become blocks of token numbers, each with a dictionary of its own: one pass, no shuffle.
2. Dictionaries are cut by hash into shards, as many as their total size asks for; a shard sums the counts of its tokens over all
   training texts and sends each block its own back. No task sees the whole vocabulary, nor does the driver.
3. Weights start from the classes' counts. In each of ``ROUNDS`` rounds, tasks go once over a share of the training blocks (every token
   in exactly one round) by gradient steps from the common weights, in single precision; Spark averages what they reach.
4. Each block's n-grams are cut by hash into shards like its dictionary, summed there, and the sums come back. An n-gram is 40 bits of
   hash in a shard of about ``SHARD_GRAMS``, so about one in a million shares a count, however large the corpus. Families go one after the
   other, and what one has shuffled is dropped before the next.
5. Blocks meet their counts twice, in numpy, ``BATCH`` tokens at once: once for the m of each, once for the scores.

Defined cases: null and empty texts are the end alone; repeated rows count and are scored each; with no training text all counts are 0 and
the model is uniform over classes; ties of frequency go to the smaller hash; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, released, shuffles_dropped, utf8, written
from .wordscan import mix, runs

CODEC = "zstd"  # counts and numbers of tokens need few of their bits
BLOCK_BYTES = 4 * 1024**2
SHARD_TOKENS = 500_000  # dictionary entries of a shard, about
SHARD_GRAMS = 1_000_000  # n-grams of a family in a shard, at most about
GRAM_BITS = 40
WORDS = 16
HEAD = 16 * WORDS
TAILS = 32
CLASSES = HEAD // WORDS + TAILS
SYMBOLS = HEAD + TAILS + 1  # what the features know of a token; the last stands before a text
START = SYMBOLS - 1
HASHED = 1 << 12
FEATURES = 1 + 3 * SYMBOLS + HASHED
ROUNDS = 3
BATCH = 8192
SCORED = 2048  # tokens whose factors for all classes are held at once, in a processor's cache
RATE = 0.1
STRENGTH_BASE, STRENGTH_POWERS = 4.0, np.arange(-2, 13)  # what m is chosen from
END = mix(np.array([0x656E64], np.uint64))[0]
BEFORE = mix(np.array([0x737461], np.uint64))[0]  # stands before a text
FAMILIES = ((3,), (2,), (1,), (1, 2))  # how far back the words of a history lie

Weights = tuple[np.ndarray, np.ndarray]  # classes x features; words of a class x (symbols + 1, of each head class)
_WORD_COLUMNS = (SYMBOLS + 1) * (HEAD // WORDS)


def _ordered(keys: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The places of unsigned keys under 2**bits in ascending order, equal ones by place, and the keys in it.

    Key and place are sorted as one number, which is far faster than sorting places. Where both need more than 64 bits, the lowest of the key are
    left out; for the few arrays with keys that only these tell apart, places are sorted.
    """
    places = max(len(keys) - 1, 1).bit_length()
    over = max(bits + places - 64, 0)
    both = keys >> np.uint64(over) if over else keys.copy()
    both <<= np.uint64(places)
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    both &= np.uint64((1 << places) - 1)
    order = both.view(np.int64)
    ordered = keys[order]
    if over and (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    return order, ordered


def _changes(ordered: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before it, and at the first."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return new


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 64-bit keys in ascending order, the first place of each, and of each place its number."""
    order, ordered = _ordered(keys)
    new = _changes(ordered)
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(new) - 1
    return ordered[new], order[new], back


# 1. blocks


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers under 2**32, byte by byte, which compresses better than number by number."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    numbers = planes[0].astype(np.int64)
    for k in (1, 2, 3):
        if planes[k].any():
            numbers |= planes[k].astype(np.int64) << (8 * k)
    return numbers


BLOCKS = "block long, doc_ids array<long>, train array<boolean>, ends array<int>, size int, ids binary, hashes binary, counts binary, tails binary"


def _block(number: int, doc_ids: pa.Array, train: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> dict:
    rows = len(offsets) - 1
    words = runs(data, offsets, folded=True)
    n = words.per_row()
    ends = np.cumsum(n + 1)
    hashes = np.empty(int(ends[-1]), np.uint64)
    at = np.arange(len(words.row)) + words.row
    hashes[at], hashes[ends - 1] = words.hash, END
    tail = np.zeros(len(hashes), np.uint8)
    if len(at):
        last, before = data[words.end - 1].astype(np.int64), data[np.maximum(words.end - 2, words.start)].astype(np.int64)
        beyond = np.bitwise_or.reduceat(data[words.start[0] : words.end[-1]], words.start - words.start[0]) >> 7
        folded = [np.where((x >= 65) & (x <= 90), x + 32, x) for x in (last, before)]
        tail[at] = (folded[0] * 31 + folded[1] * 7) % (TAILS // 2) + (TAILS // 2) * beyond
    known, first, ids = _distinct(hashes)
    of_row = np.repeat(np.arange(rows), n + 1)
    counts = np.bincount(ids[train[of_row]], minlength=len(known))
    return {
        "block": number,
        "doc_ids": doc_ids.to_pylist(),
        "train": train.tolist(),
        "ends": ends.tolist(),
        "size": len(known),
        "ids": _planes(ids),
        "hashes": known.astype("<u8").tobytes(),
        "counts": counts.astype("<u4").tobytes(),
        "tails": tail[first].tobytes(),
    }


@released
def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    schema = pa.schema(
        [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("ends", pa.list_(pa.int32())), ("size", pa.int32())]
        + [(x, pa.binary()) for x in ("ids", "hashes", "counts", "tails")]
    )
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        train = batch.column("train").to_numpy(zero_copy_only=False)
        for low, high in chunks(offsets, BLOCK_BYTES):
            row = _block(number, batch.column("doc_id").slice(low, high - low), train[low:high], data, offsets[low : high + 1])
            yield pa.RecordBatch.from_pylist([row], schema)
            number += 1


# 2. counts


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes, so a dictionary in order of hash is cut into slices."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _slices(shards: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.frombuffer(row["hashes"], "<u8")
                edges = np.searchsorted(_shard_of(hashes, shards), np.arange(shards + 1))
                some = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": some.astype(np.int32),
                        "block": np.full(len(some), row["block"], np.int64),
                        "hashes": pa.array([row["hashes"][8 * edges[s] : 8 * edges[s + 1]] for s in some], pa.binary()),
                        "counts": pa.array([row["counts"][4 * edges[s] : 4 * edges[s + 1]] for s in some], pa.binary()),
                        "tails": pa.array([row["tails"][edges[s] : edges[s + 1]] for s in some], pa.binary()),
                    }
                )

    return cut


COUNTS = "shard int, block long, totals binary, top array<struct<hash:long,n:long,tail:int>>, tail_n array<long>, tail_v array<long>"


def _count_shard(rows: pa.Table) -> pa.Table:
    """The total count of each token of each slice; beside the first slice, the shard's share of the statistics."""
    parts = [np.frombuffer(x.as_py(), "<u8") for x in rows.column("hashes")]
    counts = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in rows.column("counts")]).astype(np.int64)
    tails = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in rows.column("tails")])
    known, first, back = _distinct(np.concatenate(parts))
    total = np.bincount(back, weights=counts, minlength=len(known)).astype(np.int64)
    tail = tails[first]
    order = np.lexsort((known, -total))[: HEAD + 1]
    order = np.union1d(order[total[order] > 0], np.flatnonzero(known == END))
    edges = np.cumsum([0, *map(len, parts)])
    n = len(parts)
    return pa.table(
        {
            "shard": rows.column("shard"),
            "block": rows.column("block"),
            "totals": pa.array([_small(total[back[a:b]]) for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
            "top": pa.array(
                [[{"hash": int(known[i].view(np.int64)), "n": int(total[i]), "tail": int(tail[i])} for i in order]] + [None] * (n - 1),
                pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64()), ("tail", pa.int32())])),
            ),
            "tail_n": pa.array([np.bincount(tail, weights=total, minlength=TAILS).astype(np.int64).tolist()] + [None] * (n - 1), pa.list_(pa.int64())),
            "tail_v": pa.array([np.bincount(tail[total > 0], minlength=TAILS).tolist()] + [None] * (n - 1), pa.list_(pa.int64())),
        }
    )


@dataclass
class Vocabulary:
    """What of the counts every task needs; of fixed size."""

    head: np.ndarray  # hashes of the head tokens, by rank
    head_n: np.ndarray
    tail_n: np.ndarray  # tokens of each tail class, and distinct ones, without the head
    tail_v: np.ndarray
    n: int
    v: int

    def __post_init__(self) -> None:
        self._order = np.argsort(self.head)

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """The rank of each token, -1 if it is not in the head."""
        known = self.head[self._order]
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[at] == hashes, self._order[at], -1)


def _vocabulary(counts: DataFrame) -> Vocabulary:
    stats = counts.where("top is not null")
    top = stats.select(F.explode("top").alias("t")).select("t.*")
    end = int(END.view(np.int64))
    best = top.where(F.col("hash") != end).orderBy(F.desc("n"), "hash").limit(HEAD - 1).collect()
    tails = stats.select(F.posexplode(F.arrays_zip("tail_n", "tail_v")).alias("tail", "of"))
    sums = {r.tail: (r.n, r.v) for r in tails.groupBy("tail").agg(F.sum("of.tail_n").alias("n"), F.sum("of.tail_v").alias("v")).collect()}
    tail_n, tail_v = (np.array([sums.get(t, (0, 0))[i] for t in range(TAILS)], np.int64) for i in (0, 1))
    n, v = int(tail_n.sum()), int(tail_v.sum())
    ends = top.where(F.col("hash") == end).agg(F.max("n")).first()[0] or 0
    head = [(end, ends, 0), *((r.hash, r.n, r.tail) for r in best)]
    head.sort(key=lambda x: (-x[1], x[0]))
    for _, count, tail in head:
        tail_n[tail] -= count
        tail_v[tail] -= count > 0
    return Vocabulary(np.array([h for h, _, _ in head], np.int64).view(np.uint64), np.array([c for _, c, _ in head], np.int64), tail_n, tail_v, n, v)


# 3. weights


def _first_weights(words: Vocabulary) -> Weights:
    """Weights under which each factor is a smoothed share of counts."""
    by_class, by_word = np.zeros((CLASSES, FEATURES), np.float32), np.zeros((WORDS, _WORD_COLUMNS), np.float32)
    head = np.full(HEAD, 0.0)
    head[: len(words.head_n)] = words.head_n
    head = head.reshape(-1, WORDS)
    by_class[:, 0] = np.log(np.concatenate((head.sum(axis=1), words.tail_n)) + 0.5)
    by_word[:, : HEAD // WORDS] = np.log(head.T + 0.5)
    used = np.arange(HEAD).reshape(-1, WORDS) < len(words.head_n)
    by_word[:, : HEAD // WORDS][~used.T] = -1e4  # places without a token
    if len(words.head_n) < HEAD:
        by_class[: HEAD // WORDS, 0][~used.any(axis=1)] = -1e4
    return by_class, by_word


@dataclass
class Sequence:
    """A block's tokens as the model sees them."""

    kind: np.ndarray  # class of each token
    word: np.ndarray  # place in a head class
    features: list[np.ndarray]  # columns of the class weights, besides the first
    last: np.ndarray  # symbol before

    def part(self, at) -> Sequence:
        return Sequence(self.kind[at], self.word[at], [f[at] for f in self.features], self.last[at])


def _sequence(row: dict, words: Vocabulary) -> tuple[Sequence, np.ndarray]:
    """The tokens of a block, and the rank or -1 of each dictionary entry."""
    ids, ends = _from_planes(row["ids"]), np.array(row["ends"], np.int64)
    rank = words.ranks(np.frombuffer(row["hashes"], "<u8"))
    tails = np.frombuffer(row["tails"], np.uint8).astype(np.int64)
    symbol = np.where(rank >= 0, rank, HEAD + tails)[ids]
    starts = np.concatenate(([0], ends[:-1]))
    back = []
    for k in (1, 2, 3):
        before = np.full(len(ids), START, np.int64)
        before[k:] = symbol[:-k]
        for j in range(k):  # no token that far back in the text
            at = starts + j
            before[at[at < ends]] = START
        back.append(before)
    pair = (mix((back[0] * SYMBOLS + back[1]).astype(np.uint64)) % np.uint64(HASHED)).astype(np.int64)
    features = [1 + back[0], 1 + SYMBOLS + back[1], 1 + 2 * SYMBOLS + back[2], 1 + 3 * SYMBOLS + pair]
    kind = np.where(symbol < HEAD, symbol // WORDS, symbol - HEAD + HEAD // WORDS)
    return Sequence(kind, symbol % WORDS, features, back[0]), rank


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=0)
    return x - np.log(np.exp(x).sum(axis=0))


def _by_history(s: Sequence) -> np.ndarray:
    """The places of tokens in order of the features of the last two, which many of them share."""
    one, two, _, pair = (f.astype(np.uint64) for f in s.features)
    size = np.uint64(FEATURES)
    return _ordered((one * size + two) * size + pair, (FEATURES**3).bit_length())[0]


@dataclass
class Factors:
    """Two factors for each token, whose product, divided by its sum, is the share of each class after the token's history.

    One is for the features of the last two tokens, made once for a run of tokens where these are equal, one for the token before them, made
    once for each such feature. So exponentials are of these and not of all tokens.
    """

    near: np.ndarray  # runs x classes
    first: np.ndarray  # of each run
    far: np.ndarray
    third: np.ndarray  # row of far of each token


def _factors(s: Sequence, by_class: np.ndarray) -> Factors:
    one, two, three, pair = s.features
    w = by_class.T
    first = np.flatnonzero(_changes(one) | _changes(two) | _changes(pair))
    used = np.zeros(len(w), bool)
    used[three] = True
    near = w[one[first]]
    for f in (two[first], pair[first], [0]):
        near += w[f]
    far = w[used]
    for x in (near, far):
        x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
    return Factors(near, first, far, (np.cumsum(used) - 1)[three])


def _class_shares(s: Sequence, by_class: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of each class after each token's history, and the first of each run of tokens with equal last two."""
    f = _factors(s, by_class)
    shares = np.repeat(f.near, np.diff(f.first, append=len(s.kind)), axis=0)
    shares *= f.far[f.third]
    total = shares @ np.ones(shares.shape[1], shares.dtype)
    shares /= np.maximum(total, np.finfo(shares.dtype).tiny)[:, None]
    return shares, f.first


def _class_logs(s: Sequence, by_class: np.ndarray) -> np.ndarray:
    """Logarithms of these shares, classes x tokens."""
    with np.errstate(divide="ignore"):  # places without a token
        return np.log(_class_shares(s, by_class)[0].T)


def _word_columns(s: Sequence) -> tuple[np.ndarray, np.ndarray]:
    return s.kind, HEAD // WORDS * (1 + s.last) + s.kind


def _word_logs(s: Sequence, by_word: np.ndarray) -> np.ndarray:
    a, b = _word_columns(s)
    return _log_softmax((by_word.T[a] + by_word.T[b]).T)


def _every_word(by_word: np.ndarray) -> np.ndarray:
    """``_word_logs`` of each head class (rows) and symbol before (rows of these), one after the other."""
    kinds = np.arange(HEAD // WORDS)
    last = np.repeat(np.arange(SYMBOLS), len(kinds))
    nothing = np.zeros(len(last), np.int64)
    return _word_logs(Sequence(np.tile(kinds, SYMBOLS), nothing, [], last), by_word).T.copy()


def _run_sums(rest: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of rows. Most are short, and ``reduceat`` takes its time for each."""
    size = np.diff(first, append=len(rest))
    sums = rest[first]
    two, longer = np.flatnonzero(size == 2), np.flatnonzero(size > 2)
    sums[two] += rest[first[two] + 1]
    if len(longer):
        starts = np.cumsum(size[longer]) - size[longer]
        sums[longer] = np.add.reduceat(rest[np.repeat(size > 2, size)], starts, axis=0)
    return sums


def _sums(column: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns, and the sums of the rows of ``rest`` that have them."""
    order = np.argsort(column.astype(np.uint16), kind="stable")
    column = column[order]
    first = np.flatnonzero(_changes(column))
    return column[first], _run_sums(rest[order], first)


def _class_gradients(s: Sequence, by_class: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the class weights that the tokens have, each once, and their gradients as rows."""
    s = s.part(_by_history(s))
    one, two, three, pair = s.features
    rest, first = _class_shares(s, by_class)
    rest[np.arange(len(s.kind)), s.kind] -= 1
    near = _run_sums(rest, first)
    sums = [_sums(one[first], near), _sums(two[first], near), _sums(three, rest), _sums(pair[first], near)]
    columns, rows = zip((np.zeros(1, np.int64), near.sum(axis=0, keepdims=True)), *sums, strict=True)
    return np.concatenate(columns), np.concatenate(rows)


def _word_gradients(s: Sequence, by_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of the word weights; all tokens are in head classes."""
    last, first, at = np.unique(_word_columns(s)[1], return_index=True, return_inverse=True)
    alike = s.part(first)
    rest = np.exp(_word_logs(alike, by_word)).T * np.bincount(at)[:, None].astype(by_word.dtype)
    rest -= np.bincount(at * WORDS + s.word, minlength=rest.size).reshape(rest.shape).astype(by_word.dtype)
    kinds, sums = _sums(alike.kind, rest)
    return np.concatenate((kinds, last)), np.concatenate((sums, rest))


def _descend(s: Sequence, weights: Weights, seen: Weights) -> None:
    """Gradient steps over a block, in place; ``seen`` holds the squares of the gradients so far."""
    for low in range(0, len(s.kind), BATCH):
        part = s.part(slice(low, low + BATCH))
        gradients = [_class_gradients(part, weights[0])]
        heads = np.flatnonzero(part.kind < HEAD // WORDS)
        if len(heads):
            gradients.append(_word_gradients(part.part(heads), weights[1]))
        for w, g2, (columns, g) in zip(weights, seen, gradients, strict=False):  # other columns have gradient 0, which moves nothing
            g /= g.dtype.type(len(part.kind))
            squares = g2.T[columns] + g * g
            g2.T[columns] = squares
            g *= RATE
            g /= np.sqrt(squares) + g.dtype.type(1e-4)
            w.T[columns] -= g


_CHUNKS = 16  # the weights travel in so many parts


def _train(blocks: DataFrame, words: Vocabulary) -> Weights:
    spark = blocks.sparkSession
    weights = _first_weights(words)
    if not words.n:
        return weights
    known = spark.sparkContext.broadcast(words)
    levels = int(np.log(max(blocks.count(), 1)) / np.log(64))
    for k in range(ROUNDS):
        start = spark.sparkContext.broadcast(weights)

        @released
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = tuple(w.astype(np.float32, order="F") for w in start.value)  # a column's weights side by side
            seen = tuple(np.zeros_like(w) for w in own)
            tokens = 0
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    s, _ = _sequence(row, known.value)
                    s = s.part(np.repeat(np.array(row["train"], bool), np.diff([0, *row["ends"]])))
                    _descend(s, own, seen)
                    tokens += len(s.kind)
            if tokens:
                moved = np.concatenate([(a - b).ravel() for a, b in zip(own, start.value, strict=True)]) * tokens
                task = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": np.arange(_CHUNKS, dtype=np.int32),
                        "task": np.full(_CHUNKS, task, np.int32),
                        "tokens": np.full(_CHUNKS, tokens, np.int64),
                        "moved": pa.array([x.astype("<f4").tobytes() for x in np.array_split(moved, _CHUNKS)], pa.binary()),
                    }
                )

        schema = "chunk int, task int, tokens long, moved binary"
        share = blocks.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == k).select("block", "train", "ends", "ids", "hashes", "tails")
        moves = share.mapInArrow(run, schema)
        for _ in range(levels):  # 64 tasks are summed at once, then 64 of these sums, and so on
            moves = moves.withColumn("some", F.floor(F.col("task") / 64)).groupBy("chunk", "some").applyInPandas(_add_moves, schema)
        moves = moves.groupBy("chunk").applyInPandas(_add_moves, schema)
        rows = {r.chunk: r for r in moves.collect()}  # _CHUNKS rows of fixed size
        if rows:
            moved = np.concatenate([np.frombuffer(rows[c].moved, "<f4") for c in range(_CHUNKS)]) / rows[0].tokens
            cut = weights[0].size
            weights = weights[0] + moved[:cut].reshape(weights[0].shape), weights[1] + moved[cut:].reshape(weights[1].shape)
        start.unpersist()
    return weights


def _add_moves(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(x, "<f4") for x in rows["moved"]], axis=0, dtype=np.float64)
    return pd.DataFrame({"chunk": rows["chunk"][:1], "task": rows["task"][:1] // 64, "tokens": [rows["tokens"].sum()], "moved": [total.astype("<f4").tobytes()]})


# 4. n-grams


def _bytes_of(numbers: np.ndarray, width: int) -> bytes:
    """The lowest bytes of numbers, byte by byte like ``_planes``."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_bytes(data: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return wide.view("<u8").ravel()


def _small(numbers: np.ndarray) -> bytes:
    """Numbers by as many bytes as the largest needs, after that number of bytes."""
    width = max(1, -(-int(numbers.max()).bit_length() // 8))
    return bytes([width]) + _bytes_of(numbers, width)


def _from_small(data: bytes) -> np.ndarray:
    return _from_bytes(data[1:], data[0]).astype(np.int64)


def _grams(row: dict, families: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the families: hash of history and token of each token of a block, and the text of each.

    Ends are repeated after a text, as far as a history reaches back, so that every word is a history of each distance once: n(history) is
    the count of its word, or for two words that of their pair. What follows the first end comes last, text by text.
    """
    ids, ends = _from_planes(row["ids"]), np.array(row["ends"], np.int64)
    hashes = np.frombuffer(row["hashes"], "<u8")
    text = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))
    at = np.arange(len(ids)) + 5 * text + 3  # three places before each text, two after it
    padded = np.full(len(ids) + 5 * len(ends), END)
    padded[at] = hashes[ids]
    last = at[ends - 1]
    first = at[np.concatenate(([0], ends[:-1]))] if len(ends) else last
    for k in (1, 2, 3):
        padded[first - k] = BEFORE
    for family in families:
        back = FAMILIES[family]
        more = [last + j for j in range(1, back[0])]
        place = np.concatenate((at, *more)) if more else at
        key = np.full(len(place), np.uint64(family + 1))
        for k in back:
            key = mix(key + padded[place - k])
        yield mix(key + padded[place]), np.concatenate((text, *[np.arange(len(ends), dtype=np.int32)] * len(more)))


def _in_shards(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard and hash in it as one number, under 2**63."""
    return _shard_of(hashes, shards).astype(np.uint64) << np.uint64(GRAM_BITS) | hashes & np.uint64((1 << GRAM_BITS) - 1)


_EVERY = range(len(FAMILIES))


def _gram_slices(shards: int, families: range = _EVERY):
    @released
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                train = np.array(row["train"], bool)
                for family, (keys, texts) in zip(families, _grams(row, families), strict=True):
                    both = _in_shards(keys, shards) << np.uint64(1) | train[texts]
                    both.sort()
                    own = both >> np.uint64(1)
                    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                    own = own[first]
                    counts = np.add.reduceat((both & np.uint64(1)).astype(np.int64), first)
                    edges = np.searchsorted(own, np.arange(shards + 1, dtype=np.uint64) << np.uint64(GRAM_BITS))
                    some = np.flatnonzero(np.diff(edges))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": (family * shards + some).astype(np.int32),
                            "block": np.full(len(some), row["block"], np.int64),
                            "grams": pa.array([_bytes_of(own[edges[s] : edges[s + 1]], GRAM_BITS // 8) for s in some], pa.binary()),
                            "counts": pa.array([_small(counts[edges[s] : edges[s + 1]]) for s in some], pa.binary()),
                        }
                    )

    return cut


def _count_grams(rows: pa.Table) -> pa.Table:
    """The total count of each n-gram of each slice."""
    parts = [_from_bytes(x.as_py(), GRAM_BITS // 8) for x in rows.column("grams")]
    counts = np.concatenate([_from_small(x.as_py()) for x in rows.column("counts")])
    every = np.concatenate(parts)
    order, ordered = _ordered(every, GRAM_BITS)
    first = _changes(ordered)
    total = np.empty(len(every), np.int64)
    total[order] = np.add.reduceat(counts[order], np.flatnonzero(first))[np.cumsum(first) - 1]
    edges = np.cumsum([0, *map(len, parts)])
    totals = [_small(total[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return pa.table({"shard": rows.column("shard"), "block": rows.column("block"), "totals": pa.array(totals, pa.binary())})


Occurrences = list[tuple[np.ndarray, np.ndarray]]  # by family: of history and token, of the history


def _occurrences(row: dict, totals: np.ndarray, gram_totals: list[np.ndarray], shards: int) -> Occurrences:
    """How often the training texts have each token of a block after each of its histories, and these histories."""
    ids, ends = _from_planes(row["ids"]), np.array(row["ends"], np.int64)
    grams = []
    for (keys, _), known in zip(_grams(row, _EVERY), gram_totals, strict=True):
        every = _in_shards(keys, shards)
        order, ordered = _ordered(every, GRAM_BITS + (shards - 1).bit_length())
        counts = np.empty(len(every), np.int64)
        counts[order] = known[np.cumsum(_changes(ordered)) - 1]
        grams.append(counts[: len(ids)])
    texts = int(totals[np.searchsorted(np.frombuffer(row["hashes"], "<u8"), END)])  # of the training
    starts = np.concatenate(([0], ends[:-1]))
    found = []
    for back, n in zip(FAMILIES, grams, strict=True):
        history = np.empty(len(ids), np.int64)
        k = back[0]
        if len(back) == 1:
            history[k:] = totals[ids[:-k]]
            for j in range(k):  # k places before each text
                at = starts + j
                history[at[at < ends]] = k * texts
        else:  # the last two: the last after the one before it
            history[1:] = grams[FAMILIES.index((1,))][:-1]
            history[starts] = texts
        found.append((np.minimum(n, history), history))
    return found


def _moved(p: np.ndarray, found: tuple[np.ndarray, np.ndarray], strength: float) -> np.ndarray:
    return (found[0] + strength * p) / (found[1] + strength)


def _likelihoods(p: np.ndarray, n: np.ndarray, history: np.ndarray) -> list[float]:
    """The sum of log ``_moved`` for each power, but for what is the same for all of them.

    What stands below depends on few different histories, and what stands above on the power only where n is not 0. There it is 1 at least, so
    eight of these are multiplied before a logarithm is taken.
    """
    seen = np.flatnonzero(n)
    p, above = p[seen], n[seen].astype(np.float64)
    some = history[history > 0]
    sizes, often = np.unique(some, return_counts=True)
    logs = []
    for m in STRENGTH_BASE**STRENGTH_POWERS:
        log = (len(some) - len(seen)) * np.log(m) - (often * np.log(sizes + m)).sum()
        for low in range(0, len(seen), 8 * BATCH):
            x = p[low : low + 8 * BATCH] * m
            x += above[low : low + 8 * BATCH]
            cut = len(x) // 8 * 8
            log += np.log(x[:cut].reshape(8, -1).prod(axis=0)).sum() + np.log(x[cut:]).sum()
        logs.append(log)
    return logs


def _strengths(row: dict, totals: np.ndarray, gram_totals: list[np.ndarray], shards: int, words: Vocabulary, weights: Weights) -> pa.Table:
    """The number of training tokens of a block, and the power for each family that makes them likeliest if none counts for itself."""
    own = np.flatnonzero(np.repeat(np.array(row["train"], bool), np.diff([0, *row["ends"]])))
    p = np.exp(_token_logs(row, np.maximum(totals - 1, 0), words, weights, own))
    best = []
    for n, history in _occurrences(row, totals, gram_totals, shards):
        found = np.maximum(n[own] - 1, 0), np.maximum(history[own] - 1, 0)
        best.append(int(STRENGTH_POWERS[int(np.argmax(_likelihoods(p, *found)))]))
        p = _moved(p, found, STRENGTH_BASE ** best[-1])
    return pa.table({"tokens": [len(own)], "powers": [best]})


# 5. scores

SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _token_logs(row: dict, totals: np.ndarray, words: Vocabulary, weights: Weights, places: np.ndarray | None = None) -> np.ndarray:
    """What the softmax says of each token of a block, or of those at some places."""
    s, _ = _sequence(row, words)
    ids = _from_planes(row["ids"])
    if places is not None:
        s, ids = s.part(places), ids[places]
    tails = np.frombuffer(row["tails"], np.uint8).astype(np.int64)
    inside = np.log((totals + 0.5) / (words.tail_n + 0.5 * (words.tail_v + 1))[tails])  # of the tail class
    heads = s.kind < HEAD // WORDS
    logs = np.empty(len(ids))
    logs[~heads] = inside[ids[~heads]]
    logs[heads] = _every_word(weights[1])[HEAD // WORDS * s.last[heads] + s.kind[heads], s.word[heads]]
    order = _by_history(s)
    s = s.part(order)
    f = _factors(s, np.asfortranarray(weights[0], np.float64))
    run = np.repeat(np.arange(len(f.first)), np.diff(f.first, append=len(ids)))
    total = np.empty(len(ids))
    for low in range(0, len(ids), SCORED):
        at = slice(low, low + SCORED)
        total[at] = np.einsum("ij,ij->i", f.near[run[at]], f.far[f.third[at]])
    logs[order] += np.log(f.near[run, s.kind] * f.far[f.third, s.kind] / total)
    return logs


def _score_block(row: dict, totals: np.ndarray, gram_totals: list[np.ndarray], shards: int, words: Vocabulary, weights: Weights, strengths: list) -> pa.Table:
    ids, ends = _from_planes(row["ids"]), np.array(row["ends"], np.int64)
    base = np.log10((totals + 0.5) / (words.n + 0.5 * (words.v + 1)))
    p = np.exp(_token_logs(row, totals, words, weights))
    for found, strength in zip(_occurrences(row, totals, gram_totals, shards), strengths, strict=True):
        p = _moved(p, found, strength)
    starts = np.concatenate(([0], ends[:-1]))
    return pa.table(
        {
            "doc_id": pa.array(row["doc_ids"], pa.int64()),
            "n_tokens": ends - starts,
            "n_known": np.add.reduceat((totals > 0)[ids].astype(np.int64), starts),
            "base_score": np.add.reduceat(base[ids], starts),
            "score": np.add.reduceat(np.log10(p), starts),
        }
    )


def score(docs: DataFrame, train: Column) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens, n_known, train_tokens, base_score and score, learning from the rows where ``train``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.coalesce(train, F.lit(False)).alias("train"))
    blocks = written(rows.mapInArrow(_block_rows, BLOCKS), "token-blocks", codec=CODEC)
    sizes = blocks.agg(F.sum("size").alias("entries"), F.sum(F.element_at("ends", -1).cast("long")).alias("tokens")).first()
    shards = -(-(sizes.entries or 0) // SHARD_TOKENS) or 1
    gram_shards = -(-(sizes.tokens or 0) // SHARD_GRAMS) or 1
    gram_counts = []
    with shuffles_dropped(spark):
        slices = blocks.select("block", "hashes", "counts", "tails").mapInArrow(
            _slices(shards), "shard int, block long, hashes binary, counts binary, tails binary"
        )
        counts = written(slices.groupBy("shard").applyInArrow(_count_shard, COUNTS), "token-counts", codec=CODEC)
        for family in _EVERY:
            slices = blocks.select("block", "train", "ends", "ids", "hashes").mapInArrow(
                _gram_slices(gram_shards, range(family, family + 1)), "shard int, block long, grams binary, counts binary"
            )
            summed = slices.groupBy("shard").applyInArrow(_count_grams, "shard int, block long, totals binary")
            gram_counts.append(written(summed, "gram-counts", codec=CODEC))
    words = _vocabulary(counts)
    weights = _train(blocks, words)
    shared = spark.sparkContext.broadcast((gram_shards, words, weights))
    kinds = [df.select("block", "shard", "totals", F.lit(kind).alias("kind")) for kind, df in (("word", counts), *(("gram", x) for x in gram_counts))]
    both = reduce(DataFrame.union, kinds)

    def parts(block: pa.Table, counted: pa.Table) -> tuple:
        found = sorted(zip(*(counted.column(c).to_pylist() for c in ("kind", "shard", "totals")), strict=True), key=lambda x: x[:2])
        totals = np.concatenate([_from_small(x) for kind, _, x in found if kind == "word"])
        grams = [
            np.concatenate([_from_small(x) for kind, shard, x in found if kind == "gram" and shard // gram_shards == family])
            for family in _EVERY
        ]
        return block.to_pylist()[0], totals, grams, *shared.value

    def fit(block: pa.Table, counted: pa.Table) -> pa.Table:
        return _strengths(*parts(block, counted))

    own = blocks.select("block", "doc_ids", "train", "ends", "ids", "hashes", "tails")
    strengths = np.ones(len(FAMILIES))
    if words.n:
        fits = own.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(fit, "tokens long, powers array<long>")
        # whole numbers, so their sums do not depend on the order of blocks
        sums = [F.sum(F.col("tokens") * F.get("powers", F.lit(family))).alias(f"powers_{family}") for family in _EVERY]
        with shuffles_dropped(spark):
            total = fits.agg(F.sum("tokens").alias("tokens"), *sums).first()
        strengths = STRENGTH_BASE ** np.array([total[f"powers_{family}"] / total["tokens"] for family in _EVERY])

    def run(block: pa.Table, counted: pa.Table) -> pa.Table:
        return _score_block(*parts(block, counted), strengths)

    scored = own.drop("train").groupBy("block").cogroup(both.groupBy("block")).applyInArrow(run, SCORES)
    return scored.withColumn("train_tokens", F.lit(words.n).cast("long"))
