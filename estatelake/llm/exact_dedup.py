"""Exact dedup (DataFrame functions only).

Texts are equal when they are identical after deleting every character of
``[\\x20\\x09-\\x0D]``. Skew-safe combining in three stages, each of which
groups by SHA-256 digest *and* the full normalised content, so a digest
collision never merges two texts:

1. local: the map-side half of the first aggregation leaves one row per
   content and map task;
2. salted: those rows meet by (digest, content, salt), the salt being the map
   task, so a group that holds a third of all rows arrives as at most
   ``salts`` rows per reducer wave instead of millions;
3. global: the salt winners combine into one winner per content.

Rows then look their winner up by the digest and a second 64-bit hash of the
content, which tells apart two contents that might share a digest. A hot
digest is one row on the winners' side, so adaptive execution can split the
members' side of that join.

The kept row has the most code points in its original text, then the smallest
``doc_id``. The aggregation state is one DECIMAL (length, then inverted id),
which stays in the hash aggregate's fixed-width buffer.

Cases: NULL text counts as empty; empty texts form one group; repeated rows
are members like any other (``kept`` is true for every row that repeats the
winning id and content); NULL ids sort last and come back as NULL; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MAX_ID, SPACES, id_key, materialize

SHIFT = "1" + "0" * 20  # above any inverted id


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _rank(length: Column, doc: Column) -> Column:
    """One decimal that orders by length, then by smaller id."""
    shift = F.lit(SHIFT).cast("decimal(21,0)")
    inverted = (F.lit(MAX_ID).cast("decimal(20,0)") - doc.cast("decimal(20,0)")).cast("decimal(20,0)")
    return (length.cast("decimal(11,0)") * shift + inverted).cast("decimal(38,0)")


def winners(rows: DataFrame, salts: int = 32) -> DataFrame:
    """One row per distinct content: digest, content, best (rank), n."""
    local = (rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
             .groupBy("digest", "content", "salt")
             .agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n")))
    return (local.groupBy("digest", "content")
            .agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size")))


def exact_dedup(docs: DataFrame, salts: int = 32) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its group: doc_id, keep_id,
    group_size, kept, text_sha256."""
    rows = (docs.select(id_key().alias("doc_id"), F.char_length(F.coalesce("text", F.lit(""))).alias("length"),
                        normalised(F.col("text")).alias("content"))
            .withColumn("digest", F.unhex(F.sha2(F.col("content").cast("binary"), 256))))
    rows = rows.withColumn("rank", _rank(F.col("length"), F.col("doc_id")))
    best = winners(rows, salts)
    shift = F.lit(SHIFT).cast("decimal(21,0)")
    best = best.select("digest", F.xxhash64("content").alias("check"), "rank", "group_size",
                       (F.lit(MAX_ID).cast("decimal(20,0)") - F.col("rank") % shift).cast("long").alias("keep_id"))
    best = materialize(best, "dedup-winners")
    members = rows.select("doc_id", "digest", "rank", F.xxhash64("content").alias("check"))
    # (digest, check) is a key of ``best``: its rows differ in content, and two
    # contents that share a SHA-256 digest still differ in the second hash.
    out = members.join(best.withColumnRenamed("rank", "best_rank"), ["digest", "check"])
    null_id = F.lit(MAX_ID)
    return out.select(F.nullif("doc_id", null_id).alias("doc_id"), F.nullif("keep_id", null_id).alias("keep_id"),
                      F.col("group_size").cast("long").alias("group_size"),
                      (F.col("rank") == F.col("best_rank")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))
