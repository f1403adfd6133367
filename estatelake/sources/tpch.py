"""Readers for the driver-supplied parquet tables and the derived listing view.

The supplied tables hold no property listings, so a ``listing`` view is
derived from ``orders ⋈ customer ⋈ nation`` with plain arithmetic that an
independent SQL engine reproduces exactly (see ``plans/oracle.py``). One URL
belongs to one customer, and every order of that customer is one dated
snapshot of the listing, so keep-latest, upsert and history operators see
~10 snapshots per URL.

Join strategy: ``orders ⋈ customer`` is a large-large equi-join on the
customer key (sort-merge, both sides shuffled once on the key; AQE splits a
skewed key). ``nation`` is a fixed 25-row dimension; AQE broadcasts it when
its runtime size is under ``autoBroadcastJoinThreshold`` and falls back to a
shuffle join otherwise, so no unchecked broadcast hint is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed rendering of the derived listing (shared with the SQL oracle).
LISTING_BASE_URL = "https://x.example/en/detail/"
PROPERTY_TYPES = ["apartment", "house", "villa", "residence"]      # by c_custkey % 4
ENERGY_CLASSES = ["A+", "A", "B", "C", "D", "E", "F", "G"]         # by o_orderkey % 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived listing table (F-5 columns + flags + ``listing_id``)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    ptype = F.element_at(F.array(*[F.lit(t) for t in PROPERTY_TYPES]),
                         (F.col("c_custkey") % 4 + 1).cast("int"))
    rent = (F.col("c_custkey") % 5) == 0
    postal = (F.lit(1000) + F.col("c_custkey") % 9000).cast("string")
    city = F.lower("n_name")
    ok = F.col("o_orderkey")
    url = F.concat(F.lit(LISTING_BASE_URL), ptype, F.lit("/for-"),
                   F.when(rent, "rent").otherwise("sale"), F.lit("/"), postal, F.lit("/"),
                   city, F.lit("/"), F.col("o_custkey").cast("string"))
    title = F.when(ok % 17 != 0,
                   F.concat(ptype, F.when(rent, F.lit(" for rent in ")).otherwise(F.lit(" for sale in ")),
                            city))
    surface = F.when(ok % 11 != 0, (F.lit(5) + (ok * 37) % 1100).cast("double"))
    price = F.col("o_totalprice").cast("double")
    return j.select(
        ok.alias("listing_id"),
        F.to_date("o_orderdate").alias("snapshot_date"),
        url.alias("url"),
        title.alias("title"),
        city.alias("city"),
        postal.alias("postal_code"),
        F.concat(F.lit("region_"), F.col("n_regionkey").cast("string")).alias("region"),
        F.when(ok % 13 != 0, ptype).alias("property_type"),
        price.alias("price"),
        surface.alias("surface_m2"),
        (ok % 6).cast("int").alias("bedrooms"),
        (F.lit(1) + ok % 3).cast("int").alias("bathrooms"),
        (F.lit(1900) + ok % 125).cast("int").alias("year_built"),
        F.element_at(F.array(*[F.lit(e) for e in ENERGY_CLASSES]), (ok % 8 + 1).cast("int"))
        .alias("energy_label"),
        F.when(surface > 0, price / surface).alias("price_per_m2"),
        rent.alias("is_rent"),
        (~rent).alias("is_sale"),
    )
