"""Schema reconciliation and the listing normaliser.

Column resolution is metadata work: it reads ``df.columns`` on the driver
(names only, never rows) and emits one ``select`` of native expressions.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from .. import vocab
from ..functions import flags, parse


def resolve_column(columns: Sequence[str], exact: Sequence[str], contains: Sequence[str] = (),
                   exclude: Sequence[str] = ()) -> str | None:
    """Names are compared lower-cased and trimmed; the exact names are
    tried in the given order, then the first column (in table order) whose
    name contains any keyword. Columns containing an ``exclude`` word are
    skipped by the substring search."""
    colmap = {}
    for c in columns:
        colmap.setdefault(c.lower().strip(), c)
    for n in exact:
        if n in colmap:
            return colmap[n]
    for lc, c in colmap.items():
        if any(x in lc for x in exclude):
            continue
        if any(k in lc for k in contains):
            return c
    return None


def resolve_field(df: DataFrame, field: str) -> str | None:
    """Resolve a logical listing field through the alias dictionary."""
    exact, contains = vocab.ALIASES[field]
    return resolve_column(df.columns, exact, contains, vocab.SUBSTRING_EXCLUDE.get(field, ()))


def _typed_null(t: str) -> Column:
    return F.lit(None).cast(t)


def _dtype(df: DataFrame, col: str) -> DataType:
    return df.schema[col].dataType


def select_fixed(df: DataFrame, columns: Sequence[str], types: dict[str, str] | None = None
                 ) -> DataFrame:
    """P6 (+ P5 defaults): ordered projection to a fixed list; absent
    columns become typed NULLs."""
    types = types or {}
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else _typed_null(types.get(c, "string")).alias(c)
                       for c in columns])


def string_blob(df: DataFrame) -> Column:
    """All string columns of the row joined by a space (NULLs skipped)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return F.concat_ws(" ", *[F.col(c) for c in cols]) if cols else F.lit("")


def _int_euros(df: DataFrame, col: str | None) -> Column:
    """X2 for any column type: numbers truncate to whole units, text is parsed."""
    if col is None:
        return _typed_null("bigint")
    if isinstance(_dtype(df, col), NumericType):
        return F.abs(F.col(col)).cast("bigint")
    return parse.price_to_int_eur(F.col(col))


def _surface(df: DataFrame, col: str | None) -> Column:
    if col is None:
        return _typed_null("double")
    if isinstance(_dtype(df, col), NumericType):
        return F.col(col).cast("double")
    return parse.surface_to_float_m2(F.col(col))


def _text(col: str | None) -> Column:
    return F.col(col).cast("string") if col else _typed_null("string")


def normalize_listing(df: DataFrame, run_date: _dt.date | str | None = None) -> DataFrame:
    """The listing normaliser: resolve columns through the alias dictionary,
    parse price (X2, then X4 over title and description), surface (X3, then
    X5), int-ish counts, multilingual rent/sale flags (X10) and a guarded
    €/m² (P9). ``snapshot_date`` keeps the input's date when there is one,
    else the run date (a parameter)."""
    r = {f: resolve_field(df, f) for f in vocab.ALIASES}
    title, desc = _text(r["title"]), _text(r["description"])
    url = _text(r["url"])
    in_sale = "is_sale" if "is_sale" in df.columns else None
    if "snapshot_date" in df.columns:
        t = _dtype(df, "snapshot_date")
        snap = (F.col("snapshot_date") if isinstance(t, DateType)
                else F.to_date("snapshot_date") if isinstance(t, (TimestampType, TimestampNTZType))
                else flags.to_day("snapshot_date"))
    else:
        if run_date is None:
            raise ValueError("rows without snapshot_date need a run_date")
        snap = F.lit(str(run_date)).cast("date")
    # Stage 1: resolve + parse. Later stages reference these columns, so each
    # parser runs once per row (Catalyst does not re-inline a non-trivial
    # expression that is referenced more than once).
    s1 = df.select(
        url.alias("url"),
        _int_euros(df, r["price"]).alias("_p0"),
        _int_euros(df, r["bedrooms"]).try_cast("int").alias("bedrooms"),
        _int_euros(df, r["bathrooms"]).try_cast("int").alias("bathrooms"),
        _surface(df, r["surface_m2"]).alias("_s0"),
        _int_euros(df, r["year_built"]).try_cast("int").alias("year_built"),
        title.alias("title"),
        desc.alias("_desc"),
        _text(r["city"]).alias("city"),
        _text(r["postal_code"]).alias("postal_code"),
        _text(r["property_type"]).alias("property_type"),
        _text(r["energy_label"]).alias("energy_label"),
        (F.col(in_sale).cast("boolean") if in_sale else F.lit(None).cast("boolean")).alias("_sale_in"),
        string_blob(df).alias("_blob"),
        snap.alias("snapshot_date"),
    )
    # Stage 2: text fallbacks for price and surface.
    s2 = s1.withColumns({
        "price": F.coalesce(F.col("_p0"), parse.price_from_text("title"),
                            parse.price_from_text("_desc")).cast("double"),
        "surface_m2": F.coalesce(F.col("_s0"), parse.surface_from_text("title"),
                                 parse.surface_from_text("_desc")),
    })
    # Stage 3: flags and €/m² over the parsed columns.
    rent, sale = flags.rent_sale_flags("url", F.col("_blob"), F.col("price"), "_sale_in")
    s3 = s2.withColumns({"is_rent": rent, "is_sale": sale,
                         "price_per_m2": F.when(F.col("surface_m2") > 0,
                                                F.col("price") / F.col("surface_m2"))})
    return s3.select("url", "price", "bedrooms", "bathrooms", "surface_m2", "year_built", "title",
                     "city", "postal_code", "property_type", "energy_label", "is_rent", "is_sale",
                     "snapshot_date", "price_per_m2")


def rename_url_column(df: DataFrame) -> DataFrame | None:
    """Rename the first of url/urls/link/href (any case) to ``url``;
    ``None`` when the frame has no URL column."""
    hit = next((c for c in df.columns if c.lower() in vocab.URL_COLUMN_NAMES), None)
    if hit is None:
        return None
    return df if hit == "url" else df.withColumnRenamed(hit, "url")


def fill_zero(df: DataFrame, cols: Sequence[str] = ("bedrooms", "bathrooms")) -> DataFrame:
    """P11."""
    return df.fillna(0, subset=[c for c in cols if c in df.columns])


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric coercion; unparsable text -> NULL (never an error)."""
    out = df
    for c in cols:
        if c in df.columns and not isinstance(_dtype(df, c), NumericType):
            out = out.withColumn(c, parse.safe_double(F.trim(F.col(c).cast("string")), signed=True))
        elif c in df.columns:
            out = out.withColumn(c, F.col(c).cast("double"))
    return out


SCORING_TYPES = {"surface_m2": "double", "year_built": "int", "bedrooms": "int", "bathrooms": "int",
                 "postal_code": "string", "city": "string", "property_type": "string",
                 "energy_label": "string", "region": "string"}


def _truncated(v):
    """Integer part, toward zero; NULL when it does not fit."""
    return F.when(v < 0, F.ceil(v)).otherwise(F.floor(v)).try_cast("int")


def scoring_rows(requests: DataFrame) -> DataFrame:
    """P10 over a table of requests: keep the 9 expected features (extras
    dropped, absent -> NULL); numbers coerced (ints via float), strings kept."""
    have = set(requests.columns)
    cols = []
    for k, t in SCORING_TYPES.items():
        if k not in have:
            cols.append(_typed_null(t).alias(k))
            continue
        c = F.col(k)
        if t == "string":
            cols.append(c.cast("string").alias(k))
        elif isinstance(_dtype(requests, k), NumericType):
            v = c.cast("double")
            cols.append((v if t == "double" else _truncated(v)).alias(k))
        else:
            v = parse.safe_double(F.trim(c.cast("string")), signed=True)
            cols.append((v if t == "double" else _truncated(v)).alias(k))
    extra = [c for c in requests.columns if c in ("request_id",)]
    return requests.select(*extra, *cols)
