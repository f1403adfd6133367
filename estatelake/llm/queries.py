"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontam, exact_dedup, hard_negatives, jaccard_join, langid, mixing, pii, prefix_trie, secret_scan,
               sharding, substring_dedup, url_filter)
from .common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(table(spark, sf_dir, "conversations"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return df.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")), [r.kind for r in secret_scan.BASE])


def span_digest(df: DataFrame, base: list[str]) -> DataFrame:
    """Counts of the base kinds, hash of the base spans and all spans as kind:start:end, in the order of ``spans``."""
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("long")
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    return df.select("doc_id", *[count(k).alias(f"n_{k}") for k in base],
                     F.sha2(joined(F.filter("spans", lambda s: s.kind.isin(base))).cast("binary"), 256).alias("base_sha256"),
                     joined(F.col("spans")).alias("spans"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.row_components(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(pii.find_personal_data(table(spark, sf_dir, "documents")), list(pii.KINDS))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_decontamination, op3_chat_format, op4_substring_dedup, op5_mixing, op6_sharding,
    op7_secret_scan, op8_jaccard_join, op9_url_filter, op10_language_id,
    op11_conversation_trie, op12_hard_negatives, op13_personal_data)}
