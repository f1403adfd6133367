"""Keep-latest, light dedupe and first-occurrence distinct.

All are "top-1 per key" windows: ``row_number() over (partition by key
order by ...) = 1``. Catalyst rewrites that filter into a ``WindowGroupLimit``
that runs *before* the shuffle as well, so each map task ships at most one
row per key: a URL holding a third of all rows costs one row per map task,
not a third of the data in one reducer. Every ordering ends in an explicit
tie-break so the kept row is deterministic; missing values lose
(``desc_nulls_last``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def keep_latest(df: DataFrame, key: str = "url", ts: str = "snapshot_date",
                tie_break: Sequence[str] = ("listing_id",)) -> DataFrame:
    """Newest row per key; NULL keys dropped; a NULL/unparsable
    timestamp never beats a real one; equal timestamps -> the later row
    (largest tie-break) wins."""
    order = [F.col(ts).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_break
                                             if c in df.columns]
    return top1(df.where(F.col(key).isNotNull()), [key], order)


LIGHT_KEYS = ["url", "snapshot_date", "city", "postal_code", "property_type"]


def light_dedupe(df: DataFrame, tie_break: Sequence[str] = ("listing_id",)) -> DataFrame:
    """One row per (url, snapshot_date, city, postal_code, property_type)
    — those present — keeping the highest price, then the largest surface
    (missing values lose). NULL keys group together, as in a sort-based
    dedupe."""
    keys = [c for c in LIGHT_KEYS if c in df.columns]
    if not keys:
        return df
    order = [F.col(c).desc_nulls_last() for c in ("price", "surface_m2") if c in df.columns]
    order += [F.col(c).desc_nulls_last() for c in tie_break if c in df.columns]
    return top1(df, keys, order)


def first_by_url(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """First occurrence of each non-null URL in file order (``order_cols``
    e.g. source file path then row id)."""
    return top1(df.where(F.col("url").isNotNull()), ["url"],
                [F.col(c).asc_nulls_last() for c in order_cols])


def distinct_rows(df: DataFrame) -> DataFrame:
    """A10: full-row distinct (hash aggregate with map-side partial dedupe)."""
    return df.distinct()
