"""Listing cleaning for analytics and the market summaries (P4–P5, P9, F1–F5,
A1–A5, J3/W5, O1/O3, F11).

All operators are ``DataFrame -> DataFrame`` and lazy; the run date is a
parameter, never the wall clock, so reruns are reproducible.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from ..functions import flags, parse
from .stats import summarize


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def price_per_m2(price="price", surface="surface_m2") -> Column:
    """One guarded form for every variant: NULL unless surface > 0."""
    p, s = _c(price).cast("double"), _c(surface).cast("double")
    return F.when(s > 0, p / s)


def _is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, NumericType)


def prepare_rebuild(df: DataFrame, run_date: _dt.date | str | None = None) -> DataFrame:
    """P4 → P5 → X6/X7 → X8 → X9 → X12/X11 → P9 over a history/raw frame.

    * legacy names (``surface``, ``postal-code``, ``snapshot_ts``) are used
      only when the modern column is absent;
    * missing columns get typed NULL defaults; ``snapshot_date`` defaults to
      the run date (a parameter);
    * numeric price/surface columns pass through, text is parsed;
    * property type is inferred only where missing/empty, rent flag from the
      URL only where NULL.
    """
    cols = set(df.columns)
    if "surface" in cols and "surface_m2" not in cols:
        df = df.withColumn("surface_m2", F.col("surface"))
    if "postal-code" in cols and "postal_code" not in cols:
        df = df.withColumn("postal_code", F.col("`postal-code`"))
    if "snapshot_ts" in cols and "snapshot_date" not in cols:
        df = df.withColumn("snapshot_date", flags.to_day("snapshot_ts"))
    cols = set(df.columns)
    for c in ["url", "title", "city", "property_type", "postal_code"]:
        if c not in cols:
            df = df.withColumn(c, F.lit(None).cast(StringType()))
    for c in ["bedrooms", "bathrooms", "price", "surface_m2"]:
        if c not in cols:
            df = df.withColumn(c, F.lit(None).cast("double"))
    if "is_rent" not in cols:
        df = df.withColumn("is_rent", flags.is_rent_from_url("url"))
    if "snapshot_date" not in cols:
        if run_date is None:
            raise ValueError("rows without snapshot_date need a run_date")
        df = df.withColumn("snapshot_date", F.lit(str(run_date)).cast("date"))

    price = parse.clean_price("price", numeric=_is_numeric(df, "price"))
    surface = parse.clean_surface("surface_m2", numeric=_is_numeric(df, "surface_m2"))
    snap_type = df.schema["snapshot_date"].dataType
    if isinstance(snap_type, DateType):
        snap = F.col("snapshot_date")
    elif isinstance(snap_type, (TimestampType, TimestampNTZType)):
        snap = F.to_date("snapshot_date")
    else:
        snap = flags.to_day("snapshot_date")
    df = df.withColumns({
        "price": price,
        "surface_m2": surface,
        "property_type": flags.fill_property_type("property_type", "url", "title"),
        "is_rent": F.coalesce(F.col("is_rent").cast("boolean"), flags.is_rent_from_url("url")),
        "snapshot_date": snap,
        "postal_code": flags.postal_digits("postal_code"),
    })
    return df.withColumn("price_per_m2", price_per_m2())


def plausible(df: DataFrame) -> DataFrame:
    """price and surface present, 10 ≤ m² ≤ 1000, €/m² NULL or within
    500..50 000."""
    ppm2 = F.col("price_per_m2")
    return df.where(
        F.col("price").isNotNull() & F.col("surface_m2").isNotNull()
        & F.col("surface_m2").between(10, 1000)
        & (ppm2.isNull() | ppm2.between(500, 50_000)))


def drop_missing(df: DataFrame, subset: list[str]) -> DataFrame:
    """drop rows with NULL in any of ``subset``."""
    return df.dropna(subset=subset)


def training_range(df: DataFrame) -> DataFrame:
    """price & surface present and 10 ≤ m² ≤ 1000."""
    return df.where(F.col("price").isNotNull() & F.col("surface_m2").isNotNull()
                    & F.col("surface_m2").between(10, 1000))


def clip_plausible(df: DataFrame) -> DataFrame:
    """NULL-out (keeping the row) m² outside 10..1000 and price < 50 000."""
    out = df
    if "surface_m2" in df.columns:
        s = F.col("surface_m2")
        out = out.withColumn("surface_m2", F.when(~F.coalesce(s.between(10, 1000), F.lit(True)),
                                                  F.lit(None).cast("double")).otherwise(s))
    if "price" in df.columns:
        p = F.col("price")
        out = out.withColumn("price", F.when(F.coalesce(p < 50_000, F.lit(False)),
                                             F.lit(None).cast("double")).otherwise(p))
    return out


def sanity_counters(df: DataFrame) -> DataFrame:
    """A5: one-row counters before the plausibility filter (NULL comparisons
    count as false), plus rows kept by F2."""
    s, ppm2 = F.col("surface_m2"), F.col("price_per_m2")
    kept = (F.col("price").isNotNull() & s.isNotNull() & s.between(10, 1000)
            & (ppm2.isNull() | ppm2.between(500, 50_000)))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("price").isNull()).alias("missing_price"),
        F.count_if(s.isNull()).alias("missing_m2"),
        F.count_if((s < 10) | (s > 1000)).alias("bad_m2"),
        F.count_if((ppm2 < 500) | (ppm2 > 50_000)).alias("bad_eur_m2"),
        F.count_if(kept).alias("kept_after_sanity"),
    )


def latest_snapshot(df: DataFrame, col: str = "snapshot_date") -> DataFrame:
    """Rows of the newest snapshot, via an uncorrelated scalar
    subquery (no single-partition window)."""
    newest = df.select(F.max(col)).scalar()
    return df.where(F.col(col) == newest)


def market_summary_v1(df: DataFrame) -> DataFrame:
    """A1: by snapshot, city, postal, type: count(*), avg price, median price,
    avg €/m²."""
    keys = ["snapshot_date", "city", "postal_code", "property_type"]
    return summarize(df, keys,
                     [F.count(F.lit(1)).alias("n_listings"), F.avg("price").alias("avg_price"),
                      F.avg("price_per_m2").alias("avg_ppm2")],
                     medians={"med_price": "price"})


def market_summary_v2(df: DataFrame) -> DataFrame:
    """A2: rows with €/m² only; by snapshot, city, type: n, median €/m²."""
    keys = ["snapshot_date", "city", "property_type"]
    d = df.where(F.col("price_per_m2").isNotNull())
    return summarize(d, keys, [F.count(F.lit(1)).alias("n")],
                     medians={"median_price_per_m2": "price_per_m2"})


def market_summary_v3(df: DataFrame) -> DataFrame:
    """A3: by snapshot, city, type keeping NULL groups; n = non-null URLs,
    median price, median €/m²."""
    keys = ["snapshot_date", "city", "property_type"]
    return summarize(df, keys, [F.count("url").alias("n")],
                     medians={"median_price": "price", "median_eur_m2": "price_per_m2"})


def history_summary(history: DataFrame) -> DataFrame:
    """The dashboard's summary of a history, all groups: rows, median price, median €/m²."""
    return summarize(history, ["snapshot_date", "city", "property_type"], [F.count(F.lit(1)).alias("n")],
                     medians={"median_price": "price", "median_eur_m2": "price_per_m2"})


def dashboard_summary(history: DataFrame, limit: int = 500) -> DataFrame:
    """A4 / O3: history summary, newest snapshot first then largest groups,
    top ``limit`` rows (the limit is the feature: a dashboard page). Ties are
    broken on the group keys so the page is deterministic."""
    s = history_summary(history)
    return s.orderBy(F.col("snapshot_date").desc_nulls_last(), F.col("n").desc(),
                     F.col("city").asc_nulls_last(), F.col("property_type").asc_nulls_last()
                     ).limit(limit)


def latest_sample(latest: DataFrame, limit: int = 200) -> DataFrame:
    """O1: newest rows first, ``limit`` rows (TakeOrderedAndProject: a
    per-partition top-k, then a merge of k rows per partition)."""
    return latest.orderBy(F.col("snapshot_date").desc_nulls_last(),
                          F.col("url").asc_nulls_last()).limit(limit)


def market_slice(df: DataFrame, city: str | None = None, property_type: str | None = None,
                 postal_contains: str | None = None) -> DataFrame:
    """parameterised slice (pushes down to the scan as filters)."""
    out = df
    if city:
        out = out.where(F.col("city") == city)
    if property_type:
        out = out.where(F.col("property_type") == property_type)
    if postal_contains:
        out = out.where(F.col("postal_code").contains(postal_contains))
    return out
