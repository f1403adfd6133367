"""Raw drops derived from the driver tables, written by Spark into the shared
folder, for the file-zone and sink queries.

Layout of a staged day (``<root>``):
  apartments/town=<t>/part-*.csv            modern URL drops, header url / URL
  houses/town=<t>/part-*.csv
  legacy_run1/page=<p>/part-*.csv           legacy drops (any kind), header link / href
  apartments/stats/part-*.csv               a CSV without URL column (skipped)
Listings whose id is a multiple of 5, and every villa / residence, go to
the legacy drop; the others go to their kind's drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_path
from ..sources import tpch


def url_drop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lst = tpch.listing(spark, sf_dir)
    k, url = F.col("listing_id"), F.col("url")
    kind = (F.when(url.contains("/apartment/"), "apartments")
             .when(url.contains("/house/"), "houses"))
    legacy = (k % 5 == 0) | kind.isNull()
    return lst.select("url", F.col("city").alias("town"), (k % 7 + 1).alias("page"),
                      kind.alias("kind"), legacy.alias("legacy"))


def stage_url_drops(spark: SparkSession, sf_dir: str) -> str:
    root = shared_path(spark, "raw-day")
    rows = cut_lineage(url_drop_rows(spark, sf_dir))
    for kind in ("apartments", "houses"):
        for parity, header in ((1, "url"), (0, "URL")):
            (rows.where(~F.col("legacy") & (F.col("kind") == kind) & (F.col("page") % 2 == parity))
                 .select(F.col("url").alias(header), "town", "page").repartition("town")
                 .write.mode("append").option("header", "true").partitionBy("town")
                 .csv(f"{root}/{kind}"))
    for parity, header in ((1, "link"), (0, "href")):
        (rows.where(F.col("legacy") & (F.col("page") % 2 == parity))
             .select(F.col("url").alias(header), "page").repartition("page")
             .write.mode("append").option("header", "true").partitionBy("page")
             .csv(f"{root}/legacy_run1"))
    (rows.groupBy("town").agg(F.count(F.lit(1)).alias("total_urls"))
         .write.mode("append").option("header", "true").csv(f"{root}/apartments/stats"))
    return root


DETAIL_COLUMNS = ["snapshot_date", "url", "title", "city", "postal_code", "property_type",
                  "price", "surface_m2", "bedrooms", "bathrooms", "year_built", "energy_label"]


def stage_detail_drops(spark: SparkSession, sf_dir: str) -> str:
    """Details CSVs of apartments, written in two drops whose rows overlap
    (every listing id divisible by 3 appears in both)."""
    root = shared_path(spark, "details-day")
    lst = tpch.listing(spark, sf_dir).where(F.col("url").contains("/apartment/"))
    cols = [F.col(c).cast("string").alias(c) for c in DETAIL_COLUMNS]
    lst.select(*cols).write.option("header", "true").csv(f"{root}/apartments/drop1")
    (lst.where(F.col("listing_id") % 3 == 0).select(*cols)
        .write.option("header", "true").csv(f"{root}/apartments/drop2"))
    return root
