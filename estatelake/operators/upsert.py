"""Upsert of the current table and append of history.

``latest' = newest row per URL of (latest ∪ batch)``: one top-1 per key, so a
batch that arrives late never replaces a newer row, and applying a batch twice
gives the same table. Equal snapshots go to the larger tie-break, then to the
batch. NULL URLs are rejected. The top-1 is pre-limited on the map side (see
``dedupe``); J1's delete remains as an operator of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import keep_latest
from .market import market_summary_v2


def delete_matching(target: DataFrame, batch: DataFrame, key: str = "url") -> DataFrame:
    """Target rows whose key is not in the batch (``DELETE … WHERE key IN
    (SELECT key FROM batch)``). NULL keys in the batch match nothing."""
    keys = batch.select(key).where(F.col(key).isNotNull())
    return target.join(keys, key, "left_anti")


def upsert_latest(latest: DataFrame, batch: DataFrame, key: str = "url") -> DataFrame:
    """J2 (current table): the newest row per key of the table and the batch."""
    both = latest.withColumn("_fresh", F.lit(0)).unionByName(batch.withColumn("_fresh", F.lit(1)),
                                                             allowMissingColumns=True)
    return keep_latest(both, key, tie_break=("listing_id", "_fresh")).drop("_fresh")


def append_history(history: DataFrame, batch: DataFrame) -> DataFrame:
    """J2 (history): append-only union of the batch."""
    return history.unionByName(batch.where(F.col("url").isNotNull()), allowMissingColumns=True)


def batch_summary(batch: DataFrame) -> DataFrame:
    """J2 (summary): the v2 daily summary of history rows, recomputed for the
    partitions a batch touched, so several batches of one day add up."""
    return market_summary_v2(batch.where(F.col("url").isNotNull()))
