"""Corpus pipeline: five stages over ``documents``, each one of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back as the next
stage's ``docs``. All but the last return the columns of ``documents``. Rows are kept and dropped by a key of their
own (``sharding.keyed_rows``), so rows that repeat an id or have none are each judged by their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.llm import decontam, jaccard_join, langid, mixing, sharding
from estatelake.llm.common import exchanged, materialize, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a language (``und``) go; all others stay, whatever their language."""
    rows, _ = sharding.keyed_rows(docs)
    found = langid.predict(rows.select(F.col("_row").alias("doc_id"), "text"), langid.learn(docs))
    found = found.where("lang_pred <> 'und'").select(F.col("doc_id").alias("_found"))
    return rows.join(exchanged(found), F.col("_row") == F.col("_found"), "left_semi").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component the document with the smallest id stays. Documents without words link
    with nothing and stay. Rows that repeat both the id and the text of the one that stays are the same document and
    stay with it; rows without an id are a document each."""
    rows, unique = sharding.keyed_rows(docs)
    found = jaccard_join.key_components(rows.select(F.col("_row").alias("doc_id"), "text"))
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias("_keep"))
    kept = rows.join(exchanged(keep), F.col("_row") == F.col("_keep"), "left_semi")
    if unique:
        return kept.select(*docs.columns)
    kept = materialize(kept, "kept-rows")
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    same = kept.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_same"), F.col("text").isNull().alias("_void"),
                                                   digest.alias("_digest")).distinct()
    again = rows.where("doc_id IS NOT NULL").join(
        exchanged(same), (F.col("doc_id") == F.col("_same")) & (F.col("text").isNull() == F.col("_void")) & (digest == F.col("_digest")),
        "left_semi")
    return again.unionByName(kept.where("doc_id IS NULL")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a verified leak go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every document as many times as it was drawn."""
    return mixing.apply_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: place of every drawn document in the shuffled shards."""
    return sharding.shard(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("shard", shard)]

#: Language ID, mixing and sharding have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
