"""Sanity-check and repair of a normalised listing frame.

One lazy transform; missing columns are tolerated. The only global
statistic (the k€ unit guard) is a scalar subquery; the final light dedupe
is a top-1 window with a pre-shuffle group limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import flags, parse
from .dedupe import light_dedupe
from .guards import unit_guard_v1
from .market import clip_plausible

TEXT_COLUMNS = ("price_text", "title", "raw_text")


def _coerce(df: DataFrame, col: str):
    t = df.schema[col].dataType
    if isinstance(t, NumericType):
        v = F.col(col).cast("double")
        return F.when(~F.isnan(v), v)          # non-finite -> NULL
    return parse.coerce_float(F.col(col))


def repair_price(df: DataFrame) -> DataFrame:
    """A price that looks like the postal code is dropped; a missing
    price is filled from the first text column (price_text, title, raw_text)
    with a currency cue or a 'k' suffix (X15)."""
    text_cols = [c for c in TEXT_COLUMNS if c in df.columns]
    if "price" not in df.columns or not text_cols:
        return df
    p = F.col("price")
    if "postal_code" in df.columns:
        p = F.when(~flags.postal_as_price(p, F.col("postal_code")), p)
    fill = [parse.price_from_cued_text(F.col(c)) for c in text_cols]
    return df.withColumn("price", F.coalesce(p, *fill))


def repair(df: DataFrame) -> DataFrame:
    """Coerce → X17 → A6 unit guard → drop postal artifacts (X16) →
    F3 clip → guarded €/m² → W2 light dedupe."""
    out = df
    for c in ("price", "surface_m2"):
        if c in out.columns:
            out = out.withColumn(c, _coerce(out, c))
    out = repair_price(out)
    if "price" in out.columns:
        out = unit_guard_v1(out, "price")
        if "postal_code" in out.columns:
            out = out.withColumn("price", F.when(~flags.postal_as_price("price", "postal_code"),
                                                 F.col("price")))
    out = clip_plausible(out)
    if {"price", "surface_m2"} <= set(out.columns):
        denom = F.when(F.col("surface_m2") != 0, F.col("surface_m2"))
        out = out.withColumn("price_per_m2", F.col("price") / denom)
    return light_dedupe(out)
