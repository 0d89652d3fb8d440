"""License notices in texts: an exact set-containment join of text blocks with license templates, with DataFrame functions only.

Texts become words as in ``decontaminate``. A template of n words (repeats counted) is looked for in blocks of ``2 * size`` words that begin at
every multiple of ``size``, ``size`` being the least power of two that is not below n, 16 at least; so each passage of ``size`` words lies whole in
some block. A block meets a template if it holds at least ``percent`` of the template's distinct words. All blocks that do are found:

* Order: the words of all templates are counted in the whole corpus, and ordered from the rarest to the most frequent.
* Prefix: a block that shares k of a template's words has one of its rarest n - k + 1. Only places of such words are looked at.
* Length: blocks with fewer than k words of any template are left.
* Position: the i-th word of the template and j-th of the block in that order leave room for no more than min(n - i, size - j) common words, if they are
  the first common ones. The word that is a block's first in common stands for the pair, so each pair is verified once per place.

Templates are a parameter, held by the driver and sent to every task as a hash table of the prefixes and as an array of the ordered words;
``MOST_WORDS`` bounds both, and more is an error. Texts are not shuffled: what leaves their task is a row per document and per block found.

Defined cases: null and empty texts have no words and no labels; a template without words is an error; rows are told apart by id and text, repeated
rows get a row each; a null id is an id; ties (a block that meets several templates) give all their labels; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .decontaminate import words
from .license_texts import PHRASES, TEMPLATES

PERCENT = 90  # of a template's distinct words
SMALLEST = 16
MOST_WORDS = 1_000_000


@dataclass(frozen=True)
class Template:
    label: str
    number: int
    words: tuple[str, ...]  # distinct
    size: int  # half a block
    needed: int


def templates(texts: list[tuple[str, str]], percent: int = PERCENT) -> list[Template]:
    """Templates of (label, text) pairs."""
    out = []
    for number, (label, text) in enumerate(texts):
        own = plain_words(text)
        if not own:
            raise ValueError(f"template {number} ({label}) has no words")
        distinct = tuple(dict.fromkeys(own))
        size = max(SMALLEST, 1 << (len(own) - 1).bit_length())
        out.append(Template(label, number, distinct, size, -(-percent * len(distinct) // 100)))
    if sum(len(t.words) for t in out) > MOST_WORDS:
        raise ValueError(f"templates have more than {MOST_WORDS} words")
    return out


def plain_words(text: str) -> list[str]:
    """The words of a parameter, as ``decontaminate.words`` cuts them."""
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return ["".join(run) for is_word, run in groupby(folded, lambda c: c > "\x7f" or c.isdigit() or "a" <= c <= "z") if is_word]


def _order(texts: DataFrame, known: list[Template]) -> list[str]:
    """The words of all templates from the rarest in the corpus to the most frequent."""
    vocabulary = sorted({w for t in known for w in t.words})
    own = F.array_intersect(F.lit(vocabulary), words(F.col("text")))
    counted = texts.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()  # a row per template word
    n = {r.word: r.n for r in counted}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def _phrase_starts(own: Column, phrase: list[str]) -> Column:
    """Where the phrase's words stand one after the other, from 0."""
    present = F.lit(True)
    for w in phrase:
        present = present & F.array_contains(own, w)

    def begins(at: Column) -> Column:
        same = F.lit(True)
        for k, w in enumerate(phrase):
            same = same & F.get(own, at + k).eqNullSafe(F.lit(w))
        return same

    none = F.array().cast("array<int>")
    return F.when(present, F.filter(F.sequence(F.lit(0), F.size(own) - 1), begins)).otherwise(none)


def _index(spark, known: list[Template], order: list[str]) -> DataFrame:
    """A row per template and prefix word: the word, its place among the template's ordered words, the template."""
    place = {w: i for i, w in enumerate(order)}
    rows = []
    for t in known:
        own = sorted(t.words, key=place.__getitem__)
        rows += [(own[i], i, own, t.size, t.needed, t.number) for i in range(len(own) - t.needed + 1)]
    schema = "token string, i int, ordered array<string>, half int, needed int, template int"
    return spark.createDataFrame(rows, schema)


def _blocks(spread: DataFrame, index: DataFrame, order: list[str]) -> DataFrame:
    """Blocks that meet a template, from rows of a text's key, its words and the places of prefix words (``token``, ``cell`` of 16 words)."""
    met = spread.join(F.broadcast(index), "token")
    last = F.floor(F.col("cell") * SMALLEST / F.col("half"))
    met = met.withColumn("block", F.explode(F.array_distinct(F.array(last, F.greatest(last - 1, F.lit(0))))))
    span = F.slice("words", (F.col("block") * F.col("half") + 1).cast("int"), F.col("half") * 2)
    met = met.withColumn("own", F.array_intersect(F.lit(order), span))  # the block's template words, in order
    j = F.array_position("own", F.col("token")) - 1
    room = F.least(F.size("ordered") - F.col("i"), F.size("own") - j.cast("int"))
    met = met.where((F.size("own") >= F.col("needed")) & (room >= F.col("needed")))
    common = F.array_intersect("ordered", "own")
    met = met.withColumn("common", F.size(common)).where((F.get(common, F.lit(0)) == F.col("token")) & (F.col("common") >= F.col("needed")))
    return met.select("doc_id", "text_hash", "template", "block", "half", (F.col("common") / F.size("ordered")).alias("containment"))


def find_blocks(docs: DataFrame, texts: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Every block of ``docs`` (doc_id, text) that meets a template (label, text).

    A row per block and template: doc_id, text_hash, label, template (its number), first_word and n_words of the block, containment.
    """
    known = templates(texts, percent)
    order = _order(docs, known)
    index = _index(docs.sparkSession, known, order)
    labels = docs.sparkSession.createDataFrame([(t.number, t.label) for t in known], "template int, label string")
    spread = _spread(_scanned(docs, index, {}).select("doc_id", "text_hash", "words", "places"))
    found = _blocks(spread, index, order).join(F.broadcast(labels), "template")
    return found.select(
        "doc_id", "text_hash", "label", "template", (F.col("block") * F.col("half")).alias("first_word"), (F.col("half") * 2).alias("n_words"), "containment"
    ).distinct()


def _scanned(docs: DataFrame, index: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """Per row: key, words, the places of prefix words (word and cell, each once), and where each phrase stands."""
    prefix = [r.token for r in index.select("token").distinct().collect()]  # at most as many as templates have words
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    own = F.col("words")
    places = F.transform(own, lambda w, i: F.when(w.isin(prefix), F.struct(w.alias("token"), F.floor(i / SMALLEST).alias("cell"))))
    places = F.when(F.arrays_overlap(own, F.lit(prefix)), F.array_distinct(F.array_compact(places))).otherwise(F.array().cast("array<struct<token:string,cell:bigint>>"))
    starts = [_phrase_starts(own, p.split(" ")).alias(f"at_{label}") for p, label in phrases.items()]
    return rows.select("*", places.alias("places"), *starts)


def _spread(scanned: DataFrame) -> DataFrame:
    return scanned.select("*", F.inline("places")).drop("places")


def scan(docs: DataFrame, texts: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) which license phrases it has, and which labels these and the templates give.

    n_words; n_base places of phrases, first_word and last_word of them (from 0); base_labels; labels with those of templates; score: the
    greatest containment of a template that a block meets, 0 without one; n_blocks: how many (block, template) there are.
    """
    known = templates(texts, percent)
    order = _order(docs, known)
    index = _index(docs.sparkSession, known, order)
    scanned = _scanned(docs, index, phrases)
    at = {label: F.col(f"at_{label}") for label in phrases.values()}
    every = F.concat(*at.values())
    base = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for label, c in at.items()]))
    # a text whose places have no pair needs no block, so only its figures and the words of the others are written
    figures = scanned.select(
        "doc_id",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        base.alias("base"),
        F.when(F.size("places") > 0, F.col("words")).alias("words"),
        "places",
    )
    rows = written(figures, "license-rows")
    spread = _spread(rows.where(F.size("places") > 0).select("doc_id", "text_hash", "words", "places"))
    labels = docs.sparkSession.createDataFrame([(t.number, t.label) for t in known], "template int, label string")
    found = _blocks(spread, index, order).join(F.broadcast(labels), "template").groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("score"), F.count_distinct("template", "block").alias("n_blocks")
    )
    found = found.select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "found", "score", "n_blocks")
    joined = rows.drop("words", "places").join(found, rows.doc_id.eqNullSafe(found.found_id) & (rows.text_hash == found.found_hash), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("n_blocks", F.lit(0).cast("long")).alias("n_blocks"),
    )
