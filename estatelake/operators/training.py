"""Training-set builders.

Each builder is a transform chain; data-dependent choices (fallback stage,
trim target, unit guard) are scalar subqueries. Prepared rows are written out
once (shared folder) where several statistics and the rows need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, NumericType

from .. import vocab
from ..functions import flags, parse
from ..session import cut_lineage
from .dedupe import keep_latest
from .guards import fallback_cascade, trim_with_report, unit_guard_v2
from .resolve import coerce_numeric, fill_zero, normalize_listing, select_fixed

def _letters(s: str) -> str:
    return "".join(ch for ch in s.lower() if "a" <= ch <= "z")


def surface_backfill(df: DataFrame) -> Column:
    """Surface from (1) the direct fields surface_m2 / surface /
    living_area (X13, > 5), (2) spec maps ``specs`` / ``attributes`` /
    ``details`` whose key (letters only) contains a surface token, (3) a
    text scan of title / description / raw_html."""
    cands: list[Column] = []
    for k in ("surface_m2", "surface", "living_area"):
        if k in df.columns:
            t = df.schema[k].dataType
            v = F.col(k).cast("double") if isinstance(t, NumericType) else parse.range_to_float(F.col(k))
            cands.append(F.when(v > 5, v))
    tokens = sorted({_letters(t) for t in vocab.SURFACE_SPEC_TOKENS} - {""})
    for m in ("specs", "attributes", "details"):
        if m in df.columns and isinstance(df.schema[m].dataType, MapType):
            hits = F.filter(F.map_entries(F.col(m)),
                            lambda e: F.exists(F.array(*[F.lit(t) for t in tokens]),
                                               lambda tok: F.regexp_replace(F.lower(e["key"]),
                                                                            "[^a-z]", "").contains(tok)))
            vals = F.filter(F.transform(hits, lambda e: parse.range_to_float(e["value"])),
                            lambda v: v > 5)
            cands.append(F.get(vals, 0))
    for c in ("title", "description", "raw_html"):
        if c in df.columns:
            txt = F.col(c).cast("string")
            a = F.regexp_extract(txt, vocab.SURFACE_SCAN, 1)
            b = F.regexp_extract(txt, vocab.SURFACE_SCAN, 2)
            pick = F.when(b != "", parse.range_to_float(b)).otherwise(
                F.when(a != "", parse.range_to_float(a)))
            cands.append(F.when(pick > 5, pick))
    return F.coalesce(*cands) if cands else F.lit(None).cast("double")


def training_v1(raw: DataFrame) -> DataFrame:
    """M9: normalise → sale rows → fallback cascade (F6) → 9 columns →
    bedrooms/bathrooms NULL → 0. The normalised frame feeds both the stage
    counts and the rows, so it is checkpointed once (one parse pass)."""
    picked = fallback_cascade(cut_lineage(normalize_listing(raw)))
    return fill_zero(picked.select(*vocab.TRAINING_V1_COLUMNS))


def training_v2(df: DataFrame, lo: float = 0.05, hi: float = 0.95, mode: str = "qcut",
                tie_break: tuple[str, ...] = ("listing_id",)) -> DataFrame:
    """The rows of ``build_training_v2``."""
    return build_training_v2(df, lo, hi, mode, tie_break)[0]


def build_training_v2(df: DataFrame, lo: float = 0.05, hi: float = 0.95, mode: str = "qcut",
                      tie_break: tuple[str, ...] = ("listing_id",)) -> tuple[DataFrame, DataFrame]:
    """M10 and its lineage (A13): k€ guard (A7) → keep latest per URL (W1) → surface backfill (X14,
    before projection so the text columns are still there) → projection →
    numeric coercion (P7) → price > 0, m² ≤ 5 → NULL (F4) → €/m² (P9) →
    quantile trim (F8) → non-NULL target (F7)."""
    d = unit_guard_v2(df, "price")
    if "url" in d.columns and "snapshot_date" in d.columns:
        d = d.withColumn("snapshot_ts", flags.to_day("snapshot_date").cast("timestamp"))
        d = keep_latest(d, "url", "snapshot_ts", tie_break)
    if "surface_m2" not in d.columns:
        d = d.withColumn("surface_m2", F.lit(None).cast("double"))
    d = d.withColumn("surface_m2", F.coalesce(F.col("surface_m2").cast("double"), surface_backfill(d)))
    keep = [c for c in vocab.TRAINING_V2_KEEP if c in d.columns]
    extra = [c for c in ("snapshot_ts",) + tuple(tie_break) if c in d.columns]
    d = d.select(*keep, *extra)
    # guard, keep-latest and backfill run once
    d = cut_lineage(coerce_numeric(d, ["price", "surface_m2", "bedrooms", "bathrooms", "year_built"]))
    n_in = df.agg(F.count(F.lit(1)).alias("n"))
    filled = d.agg(F.count("surface_m2").alias("n"))
    d = sanity_v2(d)
    if "price" in d.columns and "surface_m2" in d.columns:
        d = d.withColumn("price_per_m2", F.when(F.col("surface_m2") > 0,
                                                F.col("price") / F.col("surface_m2")))
    out, report = trim_with_report(d, lo, hi, mode)
    lineage = report.select(n_in.scalar().alias("n_in"), filled.scalar().alias("surface_filled"), "*")
    return out, lineage


def sanity_v2(d: DataFrame) -> DataFrame:
    """price > 0; m² ≤ 5 -> NULL."""
    if "price" in d.columns:
        d = d.where(F.col("price") > 0)
    if "surface_m2" in d.columns:
        d = d.withColumn("surface_m2", F.when(~F.coalesce(F.col("surface_m2") <= 5, F.lit(False)),
                                              F.col("surface_m2")))
    return d


def training_lineage(df: DataFrame, **options) -> DataFrame:
    """One row of a training build: n_in, surface_filled (rows with a surface after the backfill, before any
    filter), trim_target, trim_lo, trim_hi, trim_dropped, n_out."""
    return build_training_v2(df, **options)[1]


def training_v3(latest: DataFrame, key: str | None = None) -> DataFrame:
    """Keep essentials → F5 → is_rent as 'Yes'/'No', categoricals as
    strings, numerics as double. Returns features + ``price`` (+ ``key``, for
    reproducible folds)."""
    d = select_fixed(latest, ([key] if key else []) + ["city", "postal_code", "property_type", "is_rent", "bedrooms",
                              "bathrooms", "surface_m2", "price"],
                     {"is_rent": "boolean", "bedrooms": "double", "bathrooms": "double",
                      "surface_m2": "double", "price": "double"})
    d = d.where(F.col("price").isNotNull() & F.col("surface_m2").isNotNull()
                & F.col("surface_m2").between(10, 1000))
    return d.select(
        *([key] if key else []),
        F.col("city").cast("string").alias("city"),
        F.col("postal_code").cast("string").alias("postal_code"),
        F.col("property_type").cast("string").alias("property_type"),
        flags.yes_no("is_rent").alias("is_rent"),
        F.col("bedrooms").cast("double").alias("bedrooms"),
        F.col("bathrooms").cast("double").alias("bathrooms"),
        F.col("surface_m2").cast("double").alias("surface_m2"),
        F.col("price").cast("double").alias("price"),
    )


__all__ = ["training_v1", "training_v2", "training_v3", "training_lineage", "surface_backfill",
           "sanity_v2", "build_training_v2"]
