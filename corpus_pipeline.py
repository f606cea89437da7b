"""A corpus pipeline: score, remove copies and near copies, mask secrets, pack.

Each stage gets what its predecessor kept, written as Parquet and read again.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from contactloom.llm import classifier, exact_dedup, ngram_join, packing, secret_scan
from contactloom.sources.staging import stage

#: Near copies share so many percent of their n-grams of so many words; op9's 3 words and 90 percent bind that query only.
NEAR_GRAM, NEAR_SHARE = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of ids that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classifier.accepted(docs, classifier.train(docs, labels))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.deduplicate(docs, NEAR_GRAM, NEAR_SHARE)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens; workers keep few pieces, since other stages ran in them and may run again."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, path, public_tokenizers.PATTERN, keep_tokens=800_000, release=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("secret_scan", secrets),
    ("retrieval_packing", packed),
]

#: A learned classifier and greedy packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
