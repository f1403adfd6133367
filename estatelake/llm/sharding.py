"""Sharding by a keyed permutation (DataFrame functions only).

Every row gets its global row number 0..N-1 in (doc_id, size, crc) order. A
Feistel network over Z_a x Z_b (a = ceil(sqrt N), b = ceil(N / a)) permutes
0..a*b-1; numbers that land at N or beyond walk the cycle until they fall
below N, which makes it a permutation of 0..N-1. Position p goes to shard
``p % shards``, slot ``p // shards``. So the law is ``rows``: shard counts are
at most one apart and slots are gapless, and both are computable from the row
number, N, the key and the shard count alone, with no further shuffle.

Row numbers need one range exchange of three narrow columns (never the text)
and a prefix sum over the counts of the range partitions.

Cases: NULL text has size 8 and the CRC of the empty text; repeated rows each
get their own position; rows that tie in all three columns are
interchangeable; NULL ids sort last; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_back, id_key, materialize, partitions

PRIME = (1 << 31) - 1
ROUNDS = 6


def number_rows(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``row_number`` (0-based, global, by ``order``). ``rows`` must be
    cheap to scan: the range exchange reads it twice (sampling, writing)."""
    spark = rows.sparkSession
    placed = (rows.repartitionByRange(max(2, partitions(spark)), *order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_nth", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    placed = materialize(placed, "row-numbers")
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range partition, not per input row
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn("row_number", F.col("_before") + F.col("_nth")) \
        .drop("_part", "_nth", "_before")


def keyed_rows(docs: DataFrame, *within: Column) -> tuple[DataFrame, bool]:
    """``docs`` with ``_row``, a key of every row for itself in the order of doc_id (NULL last), and whether the ids
    themselves are those keys. A table of unique ids is not copied; any other is numbered by doc_id, ``within`` and
    the text's hash, and written with its numbers."""
    n, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n == ids:   # NULL is not counted as an id
        return docs.withColumn("_row", F.col("doc_id").cast("long")), True
    # the place in the scan spreads rows that agree in all else
    order = [id_key(), *within, F.xxhash64("text"), F.monotonically_increasing_id()]
    names = [f"_o{i}" for i in range(len(order))]
    rows = docs.select(*[c.alias(k) for c, k in zip(order, names)], F.struct(*docs.columns).alias("_r"))
    rows = materialize(number_rows(rows, names).select("_r.*", F.col("row_number").alias("_row")), "keyed-rows")
    return rows, False


def int_div(x: Column, d: int) -> Column:
    """Exact quotient of non-negative longs (plain division goes through DOUBLE)."""
    return F.call_function("div", x, F.lit(d).cast("long"))


def feistel(df: DataFrame, col: str, n: int, key: int) -> DataFrame:
    """Adds ``_image``: one pass of the network over 0..a*b-1. A round adds a keyed function of one half to the
    other: two multiply-square steps modulo a prime below 2**31, so every product fits a BIGINT. Each step is a
    column of its own, which keeps the expressions small and inside generated code."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    df = df.withColumns({"_l": int_div(F.col(col), b), "_r": F.col(col) % b})
    for r in range(ROUNDS):
        side, other, size = ("_l", "_r", a) if r % 2 == 0 else ("_r", "_l", b)
        k1 = (key * 2654435761 + r * 40503 + 12345) % PRIME or 1
        k2 = (key * 97 + r * 7919 + 1013904223) % PRIME
        df = df.withColumn("_x", F.col(other) % PRIME)
        df = df.withColumn("_y", (F.col("_x") * F.lit(k1).cast("long") + F.lit(k2).cast("long")) % PRIME)
        df = df.withColumn("_z", (F.col("_y") * F.col("_y") + F.col("_x")) % PRIME)
        df = df.withColumn(side, (F.col(side) + (F.col("_z") * F.col("_z") + (r + 1)) % PRIME) % size)
    return df.withColumn("_image", F.col("_l") * b + F.col("_r")).drop("_l", "_r", "_x", "_y", "_z")


def permute(numbered: DataFrame, n: int, key: int = 1) -> DataFrame:
    """Adds ``position``, the image of ``row_number``. Cycle walking: fewer
    than sqrt(N) numbers lie outside 0..N-1, so a second step is rare; steps
    go on until no row is left outside."""
    # written out before it is filtered: a pushed-down filter would inline all rounds into one expression
    out = materialize(feistel(numbered, "row_number", n, key).withColumnRenamed("_image", "position"), "positions")
    while not out.where(F.col("position") >= n).select("position").isEmpty():
        out = feistel(out, "position", n, key)
        out = out.withColumn("position", F.when(F.col("position") >= n, F.col("_image")).otherwise(F.col("position")))
        out = materialize(out.drop("_image"), "positions")
    return out


def shard(docs: DataFrame, shards: int = 24, key: int = 1) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(id_key().alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    numbered = number_rows(materialize(rows, "shard-rows"), ["doc_id", "size", "text_crc32"])
    n = numbered.count()
    p = permute(numbered, n, key)
    return p.select(id_back(), "size", "text_crc32", F.lit("rows").alias("law"),
                    (F.col("position") % shards).cast("int").alias("shard"),
                    int_div(F.col("position"), shards).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "row_number")
