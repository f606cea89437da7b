"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm import (
    bpe, chat, classifier, exact_dedup, licenses, line_dedup, ngram_join, packing, periodic_runs, quality_rules, secret_scan, url_filter, whitening,
)
from contactloom.llm.queries_sql import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.apply_policy(quality_rules.ledger(_table(spark, sf_dir, "documents")), quality_rules.STRICT)
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.failed(quality_rules.BASE).alias("base_failed"), "kept", "fail_bits",
    )


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.recognise(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "by_line", "joined", F.array_join("licences", ",").alias("licences"), "restricted")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    out = chat.format_chats(chat.records(given.unionByName(extra)))
    listed = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    bad = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_filter.judge(_table(spark, sf_dir, "pages"), bad)


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(_table(spark, sf_dir, "documents"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(_table(spark, sf_dir, "documents"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(_table(spark, sf_dir, "embeddings"))


def shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = line_dedup.deduplicate(line_dedup.batches(docs), docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = periodic_runs.planted(F.col("doc_id"), F.col("text"))
    return periodic_runs.report(periodic_runs.collapse(docs.select("doc_id", text.alias("text"))))


QUERIES = {
    "op1_quality_rules": quality,
    "op2_retrieval_packing": packed,
    "op3_bpe_round_trip": bpe_round_trip,
    "op4_license_scan": licences,
    "op5_quality_classifier": quality_scores,
    "op6_chat_formatting": chats,
    "op7_url_filter": urls,
    "op8_exact_dedup": exact_copies,
    "op9_ngram_jaccard_join": near_copies,
    "op10_secret_scan": secrets,
    "op11_embedding_whitening": whitened,
    "op12_line_dedup": shared_lines,
    "op13_periodic_runs": periodic,
}
