"""Each operator as a query over its whole table, with production parameters, and the same in SQL where it can be."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import fresh_path

from . import (
    collocations,
    decontaminate,
    divergence_rules,
    id_files,
    language_profiles,
    licenses,
    maxent,
    packing,
    periodic_runs,
    quality_model,
    style_tree,
    warc,
)
from .common import in_fold, ship, table, written
from .license_texts import PHRASES, TEMPLATES
from .near_dups import near_duplicates

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@query("op1_quality_classifier")
def quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").where(~in_fold(F.col("doc_id"), 4, 2))
    weights = quality_model.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return quality_model.score(docs, weights, ["doc_id"]).select(
        "doc_id",
        in_fold(F.col("doc_id"), 4, 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality_model.ACCEPT).cast("int").alias("predicted"),
    )


@query("op2_language_id")
def language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    profiles = language_profiles.learn(docs.where(~in_fold(F.col("doc_id"), 5, 0)))
    return language_profiles.predict(docs, profiles, ["doc_id"]).select(
        "doc_id", in_fold(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@query("op3_id_files")
def token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "id-files")
    id_files.write(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return id_files.read(spark, path)


@query("op5_quality_rules")
def rules(spark: SparkSession, folder: str) -> DataFrame:
    return divergence_rules.judge(table(spark, folder, "documents"), ["doc_id"])


@query("op7_packing")
def packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query(
    "op9_decontamination",
    f"""
    WITH cut AS (
        SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
        FROM documents
        UNION ALL
        SELECT 'b', item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')
        FROM benchmark
    ),
    grams AS (
        SELECT id AS item_id, least(10, len(words)) AS length, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos, words
        FROM cut WHERE kind = 'b' AND len(words) > 0
    ),
    windows AS (SELECT DISTINCT item_id, length, list_slice(words, pos, pos + length - 1) AS gram FROM grams),
    lengths AS (SELECT DISTINCT length FROM windows),
    places AS (
        SELECT id AS doc_id, length, words, unnest(range(1, len(words) - length + 2)) AS pos
        FROM cut, lengths WHERE kind = 'd' AND len(words) >= length
    ),
    hits AS (
        SELECT p.doc_id, p.pos, p.length, w.item_id FROM places p
        JOIN windows w ON w.length = p.length AND w.gram = list_slice(p.words, p.pos, p.pos + p.length - 1)
    ),
    covered AS (
        SELECT doc_id, count(*) AS n_hit FROM (
            SELECT DISTINCT doc_id, unnest(range(pos, pos + length)) AS word FROM (SELECT DISTINCT doc_id, pos, length FROM hits)
        ) GROUP BY doc_id
    ),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
    )
    SELECT c.id AS doc_id, CAST(len(c.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
        CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM cut c LEFT JOIN covered ON covered.doc_id = c.id LEFT JOIN items ON items.doc_id = c.id
    WHERE c.kind = 'd'
    """,
)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")


@query(
    "op10_warc",
    """
    WITH digests AS (
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM firsts
    """,
)
def archives(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write(table(spark, folder, "pages"), path)
    captures = written(warc.assemble(warc.read(spark, path)), "captures")
    page = F.col("metadata.fields")["page-id"].cast("long")
    response = captures.select(
        F.col("response.record_id").alias("original"), page.alias("refers_to"), F.col("response.payload_bytes").alias("original_bytes")
    ).where(F.col("response.type") == "response")
    rows = captures.join(response, F.col("response.refers_to") == F.col("original"), "left")
    return rows.select(
        page.alias("page_id"),
        F.coalesce("response.payload_bytes", "original_bytes").alias("payload_bytes"),
        F.coalesce("response.payload_digest", F.regexp_replace("response.declared_digest", "^sha256:", "")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        "refers_to",
    )


@query("op8_near_dups")
def near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query("op4_html_extraction")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("main_text")
    return style_tree.extract(table(spark, folder, "pages"), ["page_id", "url"]).select(
        "page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars")
    )


@query("op6_lm_scores")
def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = in_fold(F.col("doc_id"), 5, 1)
    return maxent.score(table(spark, folder, "documents"), ~held_out).withColumn("held_out", held_out)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_sql() -> str:
    """The search of ``licenses`` over all pairs of a block and a template."""
    known = licenses.templates(TEMPLATES)
    rows = ",\n        ".join(
        f"({t.number}, {_text(t.label)}, {t.size}, {t.needed}, [{', '.join(map(_text, t.words))}])" for t in known
    )
    places = " UNION ALL ".join(
        f"SELECT r, {_text(label)} AS label, unnest(list_filter(range(1, len(w) + 1), lambda i: "
        + " AND ".join(f"w[i + {k}] = {_text(x)}" for k, x in enumerate(phrase.split(" ")))
        + ")) - 1 AS spot FROM cut WHERE "
        + " AND ".join(f"list_contains(w, {_text(x)})" for x in phrase.split(" "))
        for phrase, label in PHRASES.items()
    )
    return f"""
    WITH cut AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
        FROM documents
    ),
    templates(template, label, half, needed, own) AS (VALUES
        {rows}
    ),
    places AS ({places}),
    base AS (
        SELECT r, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY r
    ),
    blocks AS (
        SELECT r, half, list_distinct(w[b * half + 1 : (b + 2) * half]) AS block FROM (
            SELECT r, w, half, unnest(range(CAST(ceil(len(w) / half) AS BIGINT))) AS b FROM cut, (SELECT DISTINCT half FROM templates)
        )
    ),
    met AS (
        SELECT r, label, len(list_intersect(block, own)) / len(own) AS share FROM blocks JOIN templates USING (half)
        WHERE len(list_intersect(block, own)) >= needed
    ),
    found AS (SELECT r, max(share) AS score, count(*) AS n_blocks, list(DISTINCT label) AS labels FROM met GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
        CAST(last_word AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
        array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
        coalesce(score, 0) AS score, coalesce(n_blocks, 0) AS n_blocks
    FROM cut LEFT JOIN base USING (r) LEFT JOIN found USING (r)
    """


@query("op11_license_scan", license_sql())
def license_labels(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query(
    "op12_phrase_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ),
    cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    grams AS (
        SELECT lang, unnest(w) AS p, 1 AS k FROM cut
        UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM cut
        UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 FROM cut
    ),
    f AS MATERIALIZED (SELECT lang, p, k, count(*) AS n FROM grams GROUP BY ALL),
    c AS (SELECT lang, p, k, n AS a, string_split(p, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
    cuts AS (
        SELECT lang, p, k, a, w, 1 AS split, w[1] AS left_part, array_to_string(w[2:], ' ') AS right_part FROM c
        UNION ALL SELECT lang, p, k, a, w, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE k = 3
    ),
    scores AS (
        SELECT c.lang, c.p, c.k, c.a, c.split, x.n AS l, y.n AS r,
            CAST(CAST(c.a AS HUGEINT) * c.a * 1000000 // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.left_part JOIN f y ON y.lang = c.lang AND y.p = c.right_part
    ),
    lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, split) AS place FROM scores),
    longer AS (
        SELECT lang, p, max(a) AS a FROM (
            SELECT lang, w[1] || ' ' || w[2] AS p, a FROM c WHERE k = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE k = 3
        ) GROUP BY ALL
    ),
    kept AS (
        SELECT s.* FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.p = s.p
        WHERE place = 1 AND (g.a IS NULL OR 100 * g.a < 50 * s.a)
    ),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept),
    totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang)
    SELECT lang, CAST(rank AS BIGINT) AS rank, p AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query("op13_periodic_runs")
def periodic(spark: SparkSession, folder: str) -> DataFrame:
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return periodic_runs.periodic_runs(table(spark, folder, "documents"), ["doc_id"], checksum)
