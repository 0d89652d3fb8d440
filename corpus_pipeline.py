"""A corpus made ready for training: rules, classifier, near duplicates, benchmark passages, packing.

Each stage takes the documents its predecessor kept and returns those that it keeps, with all their columns; the last returns the
pieces of packed sequences. ``run`` writes each stage's result as Parquet to the shared folder and reads it again, so a stage that loses
executors never falls back behind its own input.

Defined cases are those of the operators. In near_dedup rows without an id stay, rows that are equal in id and text stay once, and an id with
several texts stays if one of them does.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import decontaminate, divergence_rules, packing, quality_model
from panelkit.llm.common import ship, table, whole_rows, written
from panelkit.llm.near_dups import near_duplicates

ORACLE_SQL = None  # a fitted classifier and a tokenizer have no SQL; tests hold the stages against brute force

NEAR_PERCENT = 85  # least similarity of near duplicates in near_dedup


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not too far from every language."""
    ship(spark)
    return divergence_rules.judge(whole_rows(docs, "text", "lang"), ["row"]).where("kept").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled documents of the whole corpus."""
    ship(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    weights = quality_model.fit(table(spark, sf_dir, "documents"), labels)
    scored = quality_model.score(whole_rows(docs, "text"), weights, ["row"])
    return scored.where(F.col("quality_score") >= quality_model.ACCEPT).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    ship(spark)
    kept = near_duplicates(docs, NEAR_PERCENT).where("kept and doc_id is not null").select("doc_id").distinct()
    first = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return first.union(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    ship(spark)
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 4096 tokens."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
