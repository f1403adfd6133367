"""Text rendered from the driver tables for the parser queries.

The tables hold numbers, not listing text, so price and surface text is
rendered from ``orders`` with integer arithmetic in several portal formats
(dot / space / comma / NBSP thousands, decimal comma, currency before or
after, k / M suffixes, ranges, units). The parser queries parse it back;
their SQL oracles render the same text and return the number that was
rendered (the truth), not a re-parse.

Symbols: k = o_orderkey, P = whole euros of o_totalprice, C = k % 100
(cents), S = surface 5 + (k*37) % 1100, D = k % 10 (tenths of m²),
B = k % 6 (bedrooms), Y = 1900 + k % 125 (year).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NBSP = "\u00a0"


def s(c: Column) -> Column:
    return c.cast("string")


def thousands(n: Column, sep: str) -> Column:
    """n with one thousands separator (values below 1 000 000)."""
    return F.when(n >= 1000, F.concat(s(F.floor(n / 1000)), F.lit(sep),
                                      F.lpad(s(n % 1000), 3, "0"))).otherwise(s(n))


def base(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("k"),
        F.floor("o_totalprice").cast("bigint").alias("P"),
        (k % 100).alias("C"),
        (F.lit(5) + (k * 37) % 1100).alias("S"),
        (k % 10).alias("D"),
        (k % 6).alias("B"),
        (F.lit(1900) + k % 125).alias("Y"),
    )


def pick(k: Column, n: int, variants: list[Column]) -> Column:
    e = None
    for i, v in enumerate(variants):
        e = F.when(k % n == i, v) if e is None else e.when(k % n == i, v)
    return e


def price_text(b: DataFrame) -> Column:
    """Six price formats by k % 6."""
    P, C, k = F.col("P"), F.col("C"), F.col("k")
    return pick(k, 6, [
        F.concat(F.lit("€ "), thousands(P, ".")),
        F.concat(F.lit("EUR "), s(P)),
        F.concat(thousands(P, " "), F.lit(" €")),
        F.concat(F.lit("EUR "), thousands(P, ",")),
        F.concat(F.lit("€"), thousands(P, "."), F.lit(","), F.lpad(s(C), 2, "0")),
        F.concat(thousands(P, NBSP), F.lit(" EUR")),
    ])


def cued_price_text(b: DataFrame) -> Column:
    """Eight formats by k % 8: the six price formats plus 'k' suffixes."""
    P, k = F.col("P"), F.col("k")
    six = price_text(b)
    return pick(k, 8, [six, six, six, six, six, six,
                       F.concat(F.lit("€"), s(F.floor(P / 1000)), F.lit("k")),
                       F.concat(F.lit("about "), s(F.floor(P / 1000)), F.lit(" k"))])


def portal_price_text(b: DataFrame) -> Column:
    """Six detail-page price formats by k % 6 (incl. k / M suffixes)."""
    P, k = F.col("P"), F.col("k")
    return pick(k, 6, [
        F.concat(F.lit("€ "), thousands(P, ".")),
        F.concat(F.lit("EUR "), thousands(P, ",")),
        F.concat(thousands(P, " "), F.lit(" €")),
        F.concat(s(F.floor(P / 1000)), F.lit("k")),
        F.concat(F.lit("€ "), s(F.floor(P / 100000)), F.lit("."), s(F.floor(P / 10000) % 10),
                 F.lit("M")),
        F.concat(F.lit("Prijs: "), thousands(P, "."), F.lit(" euro, "), s(k % 5 + 1),
                 F.lit(" slaapkamers")),
    ])


def surface_text(b: DataFrame) -> Column:
    """Five surface formats by k % 5."""
    S, D, k = F.col("S"), F.col("D"), F.col("k")
    return pick(k, 5, [
        F.concat(s(S), F.lit(" m²")),
        F.concat(s(S), F.lit(","), s(D), F.lit(" m²")),
        F.concat(s(S), F.lit("."), s(D), F.lit(" m2")),
        F.concat(s(S), F.lit(" sqm")),
        F.concat(thousands(S, "."), F.lit(","), s(D), F.lit(" m²")),
    ])


def range_surface_text(b: DataFrame) -> Column:
    """Five detail-page surface formats by k % 5."""
    S, D, k = F.col("S"), F.col("D"), F.col("k")
    return pick(k, 5, [
        F.concat(s(S), F.lit(" m²")),
        F.concat(s(S), F.lit(","), s(D), F.lit(" m²")),
        F.concat(thousands(S, "."), F.lit(" m²")),
        F.concat(s(S), F.lit("–"), s(S + 5), F.lit(" m²")),
        F.concat(s(S), F.lit(" to "), s(S + 10), F.lit(" m2")),
    ])
