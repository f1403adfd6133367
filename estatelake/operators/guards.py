"""Column-wide guards: statistics of the whole column decide a per-row change
(A6–A8, J4, F6, F8, A16, F7).

The statistics are one-row global aggregates attached as scalar subqueries
(``stats.scalar``): Spark evaluates them once, ships one value to the tasks
and keeps the row-level work a narrow ``Project``/``Filter`` — no cross
join, no driver round trip. Quantiles are exact (see ``stats``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .stats import exact_quantiles_by, scalar


def column_stats(df: DataFrame, value, quantiles: dict[str, float]) -> DataFrame:
    """One row: exact quantiles, max and non-null count of ``value``; computed once and written out."""
    v = cut_lineage(df.select(value.cast("double").alias("_v")))
    q = exact_quantiles_by(v, [], {n: ("_v", p) for n, p in quantiles.items()})
    one = v.agg(F.max("_v").alias("max"), F.count("_v").alias("n"))
    return cut_lineage(one.select(*[q.select(n).scalar().alias(n) for n in quantiles], "max", "n"))


def unit_guard_v1(df: DataFrame, col: str = "price") -> DataFrame:
    """If median ≤ 2 000, q90 ≤ 9 000 and max ≤ 10 000, the column is in
    k€: multiply every value by 1 000."""
    st = column_stats(df, F.col(col), {"med": 0.5, "q90": 0.9})
    applied = scalar(st, F.coalesce((F.col("med") <= 2_000) & (F.col("q90") <= 9_000)
                                    & (F.col("max") <= 10_000), F.lit(False)))
    return df.withColumn(col, F.when(applied, F.col(col) * 1000.0).otherwise(F.col(col)))


def unit_guard_v2(df: DataFrame, col: str = "price") -> DataFrame:
    """If q90 is non-zero and < 10 000 and max < 100 000, the column is in
    k€: value × 1 000 rounded half-to-even to a whole number (bigint)."""
    v = F.col(col).cast("double")
    st = column_stats(df, v, {"q90": 0.9})
    applied = scalar(st, F.coalesce((F.col("q90") != 0) & (F.col("q90") < 10_000)
                                    & (F.col("max") < 100_000), F.lit(False)))
    return df.withColumn(col, F.when(applied, F.bround(v * 1000.0, 0)).otherwise(v)
                         .cast("double"))


def unit_guard_report(df: DataFrame, col: str = "price") -> DataFrame:
    """A7 report: the stats before the guard and whether it applies."""
    st = column_stats(df, F.col(col).cast("double"), {"median": 0.5, "q90": 0.9})
    return st.select(
        F.coalesce("median", F.lit(0.0)).alias("median"), F.coalesce("q90", F.lit(0.0)).alias("q90"),
        F.coalesce("max", F.lit(0.0)).alias("max"),
        F.coalesce((F.col("q90") != 0) & (F.col("q90") < 10_000) & (F.col("max") < 100_000),
                   F.lit(False)).alias("applied"))


def any_non_null(df: DataFrame, col: str) -> Column:
    """A16 as a scalar: does ``col`` hold any value?"""
    return scalar(df.agg(F.count(col).alias("_n")), F.col("_n") > 0)


def trim_target(df: DataFrame) -> Column:
    """The trim target: €/m² when any row has one, else price."""
    if "price_per_m2" not in df.columns:
        return F.col("price")
    return F.when(any_non_null(df, "price_per_m2"), F.col("price_per_m2")).otherwise(F.col("price"))


def quantile_trim(df: DataFrame, lo: float = 0.05, hi: float = 0.95, mode: str = "qcut"
                  ) -> DataFrame:
    """F8 + F7: keep rows whose target lies in [q_lo, q_hi] (exact quantiles);
    then the final non-NULL policy on the target. ``mode`` 'none' skips the
    trim."""
    return trim_with_report(df, lo, hi, mode)[0]


def trim_with_report(df: DataFrame, lo: float, hi: float, mode: str) -> tuple[DataFrame, DataFrame]:
    """F8 + F7 and its one-row report: trim_target, trim_lo, trim_hi, trim_dropped, n_out. The input
    is written out once; target and bounds are read from a one-row table."""
    df = cut_lineage(df)
    name = F.lit("price")
    if "price_per_m2" in df.columns:
        seen = cut_lineage(df.agg((F.count("price_per_m2") > 0).alias("any")))
        name = F.when(scalar(seen, F.col("any")), F.lit("price_per_m2")).otherwise(name)
        t = F.when(name == "price_per_m2", F.col("price_per_m2")).otherwise(F.col("price"))
    else:
        t = F.col("price")
    out, q_lo, q_hi = df, F.lit(None).cast("double"), F.lit(None).cast("double")
    if mode.lower() in {"qcut", "quantile", "quantiles"}:
        st = column_stats(df, t, {"lo": lo, "hi": hi})
        q_lo, q_hi = scalar(st, F.col("lo")), scalar(st, F.col("hi"))
        out = out.where((t >= q_lo) & (t <= q_hi))
    dropped = df.agg(F.count(F.lit(1)).alias("n"))
    kept = out.agg(F.count(F.lit(1)).alias("n"))
    out = out.where(t.isNotNull())
    report = out.agg(F.count(F.lit(1)).alias("n_out")).select(
        name.alias("trim_target"), q_lo.alias("trim_lo"), q_hi.alias("trim_hi"),
        (scalar(dropped, F.col("n")) - scalar(kept, F.col("n"))).alias("trim_dropped"), "n_out")
    return out, report


def fallback_cascade(df: DataFrame) -> DataFrame:
    """among sale rows with price and surface, the first non-empty of
    strict (price > 10 000, m² > 10), relaxed (price > 1 000, m² > 10) and
    minimal (all). The stage is chosen by one aggregate (scalar subquery)."""
    base = df.where((F.col("is_sale") == True) & F.col("price").isNotNull()  # noqa: E712
                    & F.col("surface_m2").isNotNull())
    strict = (F.col("price") > 10_000) & (F.col("surface_m2") > 10)
    relaxed = (F.col("price") > 1_000) & (F.col("surface_m2") > 10)
    counts = cascade_counts(base)
    stage = scalar(counts, F.when(F.col("strict") > 0, 1).when(F.col("relaxed") > 0, 2).otherwise(3))
    return base.where(F.when(stage == 1, strict).when(stage == 2, relaxed).otherwise(F.lit(True)))


def cascade_counts(base: DataFrame) -> DataFrame:
    """F6 report: row counts of the three stages, one pass."""
    return base.agg(
        F.count_if((F.col("price") > 10_000) & (F.col("surface_m2") > 10)).alias("strict"),
        F.count_if((F.col("price") > 1_000) & (F.col("surface_m2") > 10)).alias("relaxed"),
        F.count(F.lit(1)).alias("minimal"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles of a column, one row."""
    return column_stats(df, F.col(col), {f"q{int(round(p * 100)):02d}": p for p in probs}).drop("n")
