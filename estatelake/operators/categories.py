"""Category dictionaries without the driver: categories are counted, ranked by
count through a range exchange, and joined back to the rows.

The ranks of a feature run over all its categories, by falling count, then by
value, as a string indexer would give them; rank 0 is the mode. A million
categories are a million rows of a table; the driver sees one mode per
feature.

Cases: NULLs are no category and take the mode; values that the dictionary lacks get a
NULL index; a feature without values has no categories and its rows stay NULL; an empty table gives an
empty dictionary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """feature, value, n of every category of ``cols``."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(each.alias("e")).select("e.*").where("value IS NOT NULL").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def ranked(counts: DataFrame) -> DataFrame:
    """feature, value, n, index (0-based in its feature, by falling count, then value) and number (over all features)."""
    order = ["feature", F.col("n").desc(), "value"]
    tasks = max(2, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = counts.select("feature", "value", "n").repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumns({
        "_part": F.spark_partition_id(), "_nth": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    placed = cut_lineage(placed)
    # one row per range partition and feature, not per category
    runs = placed.groupBy("feature", "_part").agg(F.count(F.lit(1)).alias("_c"), F.min("_nth").alias("_first"))
    before = runs.select("feature", "_part", "_first",
                         (F.sum("_c").over(Window.partitionBy("feature").orderBy("_part")) - F.col("_c")).alias("_before"),
                         (F.sum("_c").over(Window.orderBy("feature", "_part")) - F.col("_c")).alias("_all"))
    at = F.col("_nth") - F.col("_first")
    return placed.join(F.broadcast(before), ["feature", "_part"]).select(
        "feature", "value", "n", (F.col("_before") + at).alias("index"), (F.col("_all") + at).alias("number"))


def category_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The dictionary of ``cols``."""
    return ranked(category_counts(df, cols))


def modes(index: DataFrame) -> dict[str, str]:
    """Mode per feature: one entry a feature."""
    return {r["feature"]: r["value"] for r in index.where("index = 0").collect()}


def encode(df: DataFrame, cols: Sequence[str], index: DataFrame, fill_mode: bool = True, column: str = "index",
           suffix: str = "__i") -> DataFrame:
    """``df`` with ``<col>__i`` for each of ``cols``. The dictionary of one feature has a row per value, so a value that
    most rows share meets one row; joins are broadcast or split by AQE as sizes tell."""
    fill = modes(index) if fill_mode else {}
    for c in cols:
        mine = index.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col(column).alias(f"{c}{suffix}"))
        value = F.col(c).cast("string")
        df = df.withColumn("_v", F.coalesce(value, F.lit(fill.get(c)).cast("string")) if fill_mode else value)
        df = df.join(mine, F.col("_v") == F.col("_value"), "left").drop("_v", "_value")
    return df
