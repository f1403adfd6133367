"""Exact grouped quantiles and scalar statistics.

One distributed method serves grouped and global quantiles, several columns
in one pass over the input, other aggregates of the groups in the same pass:

1. values are counted per (group, column, value): the shuffle is keyed by the
   value too, so a group holding a third of all rows is spread over every
   reducer and no row ids or sort order are involved. Only these counts are
   written out; counts of several inputs can be added up (``quantiles_of_counts``);
2. while there are at most ``DIRECT`` counts in all, one window ranks them, and beyond that the groups of at most ``RANKED`` counts;
3. in larger groups values fall into slices, the value cut to 9 significant bits, a
   monotone function; running counts over the slices tell which slice holds the
   ranks that a quantile needs. A slice with more than ``RANKED`` different values is cut
   into 512 equal parts, again and again, until the part with the rank holds no
   more than that. So however narrow the range of the values, no task ranks more;
4. the two neighbouring ranks are interpolated linearly (as pandas' ``quantile`` /
   DuckDB's ``quantile_cont``).

``percentile_approx`` is deliberately not used: it is not equal to the exact
quantile.

Global statistics used to decide a per-row change (unit guards, trims) are
attached as *scalar subqueries* (``DataFrame.scalar()``) over a one-row table
that is computed once; there is no cross join and nothing goes through the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

DIRECT = 1 << 20   # counts that one window may rank
RANKED = 1 << 16   # different values of one slice that one task may rank
PARTS = 512        # of a slice in each further round
TINY = 5e-324      # the smallest distance of two doubles


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _unit(v: Column) -> Column:
    """The ninth significant bit of ``v``. The logarithm may round across a power of two, which is put right."""
    e = F.floor(F.log2(F.abs(v)))
    p = F.pow(F.lit(2.0), e)
    p = F.when(p > F.abs(v), p / 2).when(p * 2 <= F.abs(v), p * 2).otherwise(p)
    return F.greatest(p / 256, F.lit(TINY))


def _slice(v: Column) -> Column:
    """``v`` cut down to 9 significant bits; never decreases as ``v`` grows."""
    odd = (v == 0) | F.isnan(v) | (F.abs(v) == float("inf"))
    return F.when(odd, v).otherwise(F.floor(v / _unit(v)) * _unit(v))


def _distinct_columns(wanted: dict[str, tuple]) -> tuple[list, list[tuple]]:
    """(columns, one (name, number of its column, probability) per wanted quantile)."""
    same = lambda a, b: a is b or (isinstance(a, str) and isinstance(b, str) and a == b)
    columns: list = []
    for c, _ in wanted.values():
        if not any(same(c, x) for x in columns):
            columns.append(c)
    return columns, [(n, next(i for i, x in enumerate(columns) if same(x, c)), float(p)) for n, (c, p) in wanted.items()]


def exact_quantiles_by(df: DataFrame, keys: Sequence[str], wanted: dict[str, tuple], aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per group: ``keys``, ``aggs`` and, for each name of ``wanted`` (name -> (column, probability)), the exact
    interpolated quantile (NULLs ignored). Without ``aggs`` only groups that have a value. One pass over ``df``."""
    columns, asks = _distinct_columns(wanted)
    each = [F.struct(F.lit(i).alias("_m"), _c(c).cast("double").alias("_v")) for i, c in enumerate(columns)]
    if aggs:
        each.append(F.struct(F.lit(-1).alias("_m"), F.lit(None).cast("double").alias("_v")))
    kept = ["*"] if aggs else list(keys)
    rows = df.select(*kept, F.explode(F.array(*each)).alias("_e")).select(*kept, "_e.*").where("_v IS NOT NULL OR _m < 0")
    w = rows.groupBy(*keys, "_m", "_v").agg(F.count(F.lit(1)).alias("_w"), *aggs)
    names = [c for c in w.columns if c not in [*keys, "_m", "_v", "_w"]]
    return _quantiles(cut_lineage(w), list(keys), asks, names)


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], value: str, weight: str, wanted: dict[str, float],
                        total: str | None = None) -> DataFrame:
    """Exact quantiles of rows that are given as counts per value, which may repeat a value (the counts of several
    batches): ``keys``, ``total`` (the sum of the counts) and a column for each name -> probability."""
    w = counts.groupBy(*keys, F.lit(0).alias("_m"), F.col(value).cast("double").alias("_v")).agg(F.sum(weight).alias("_w"))
    w = cut_lineage(w.where("_v IS NOT NULL"))
    return _quantiles(w, list(keys), [(n, 0, float(p)) for n, p in wanted.items()], [], total)


def _interpolated(n: Column, p: float, low: Column, high: Column) -> Column:
    pos = (n - 1) * p
    lo, hi = F.floor(pos), F.ceil(pos)
    return F.when(lo == hi, low).otherwise((hi - pos) * low + (pos - lo) * high)


def _quantiles(w: DataFrame, keys: list[str], asks: list[tuple], names: list[str], total: str | None = None) -> DataFrame:
    """``total``: a column for the sum of the weights, where all are of one column."""
    if w.count() <= DIRECT:
        return _ranked(w, keys, asks, names, total)
    values = w.where("_m >= 0").select(*keys, "_m", "_v", "_w")
    # fewer than the counts divided by RANKED; a group of keys is large when one of its columns is
    large = cut_lineage(values.groupBy(*keys, "_m").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > RANKED).select(*keys).distinct())
    if not keys or large.isEmpty():
        q = (_ranked(values, keys, asks, [], total) if keys else _by_slices(values, keys, asks, total))
    else:
        q = _by_slices(_join_null_safe(values, F.broadcast(large), keys), keys, asks, total)
        q = q.unionByName(_ranked(_join_null_safe(values, F.broadcast(large), keys, "left_anti"), keys, asks, [], total))
    return join_on_keys(w.where("_m < 0").select(*keys, *names), q, keys) if names else q


def _ranked(w: DataFrame, keys: list[str], asks: list[tuple], names: list[str], total: str | None = None) -> DataFrame:
    """Quantiles of groups that one task can rank. One exchange by the keys serves the ranks and the groups."""
    w = w.repartition(*keys) if keys else w
    inside = Window.partitionBy(*keys, "_m")
    w = w.withColumn("_end", F.sum("_w").over(inside.orderBy("_v"))).withColumn("_n", F.sum("_w").over(inside))
    picked = []
    for i, (_, m, p) in enumerate(asks):
        mine, pos = F.col("_m") == m, (F.col("_n") - 1) * p
        for side, f in (("lo", F.floor), ("hi", F.ceil)):
            holds = mine & (f(pos) >= F.col("_end") - F.col("_w")) & (f(pos) < F.col("_end"))
            picked.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{side}{i}"))
        picked.append(F.max(F.when(mine, F.col("_n"))).alias(f"_n{i}"))
    q = w.groupBy(*keys).agg(*[F.max(F.when(F.col("_m") < 0, F.col(c))).alias(c) for c in names], *picked)
    sums = [F.col("_n0").alias(total)] if total else []
    return q.select(*keys, *names, *sums, *[_interpolated(F.col(f"_n{i}"), p, F.col(f"_lo{i}"), F.col(f"_hi{i}")).alias(n)
                                     for i, (n, _, p) in enumerate(asks)])


def _by_slices(w: DataFrame, keys: list[str], asks: list[tuple], total: str | None = None) -> DataFrame:
    group = [*keys, "_m"]
    w = w.withColumn("_s", _slice(F.col("_v")))
    s = w.groupBy(*group, "_s").agg(F.sum("_w").alias("_c"), F.count(F.lit(1)).alias("_k"))
    s = s.withColumn("_before", F.sum("_c").over(Window.partitionBy(*group).orderBy("_s")) - F.col("_c")) \
        .withColumn("_n", F.sum("_c").over(Window.partitionBy(*group)))
    each = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(m).alias("m"), F.lit(p).alias("p"), F.lit(up).alias("up"))
                     for n, m, p in asks for up in (False, True)])
    t = s.select("*", F.explode(F.filter(each, lambda a: a.m == F.col("_m"))).alias("_a")).withColumn("_pos", (F.col("_n") - 1) * F.col("_a.p"))
    t = t.withColumn("_rank", F.when(F.col("_a.up"), F.ceil("_pos")).otherwise(F.floor("_pos")))
    inside = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c"))
    t = t.where(inside).select(*group, "_s", F.col("_a.name").alias("_name"), F.col("_a.p").alias("_p"), F.col("_a.up").alias("_up"),
                               "_n", "_rank", F.col("_s").alias("_from"), _unit(F.col("_s")).alias("_width"), "_before", "_k",
                               F.lit(False).alias("_deep"))
    t = cut_lineage(t)
    while not (big := t.where(F.col("_k") > RANKED)).isEmpty():
        t = cut_lineage(t.where(F.col("_k") <= RANKED).unionByName(_narrowed(w, group, big)))
    cols = ["_name", "_p", "_up", "_n", "_rank", "_from", "_width", "_before"]
    whole = _join_null_safe(w, t.where("NOT _deep").select(*group, "_s", *cols), [*group, "_s"])
    part = _within(w, t.where("_deep").select(*group, "_s", *cols), group)
    hit = whole.unionByName(part.select(*whole.columns))
    hit = hit.withColumn("_end", F.col("_before") + F.sum("_w").over(Window.partitionBy(*group, "_name", "_up").orderBy("_v")))
    hit = hit.where((F.col("_rank") >= F.col("_end") - F.col("_w")) & (F.col("_rank") < F.col("_end")))
    side = lambda up: F.max(F.when(F.col("_up") == up, F.col("_v")))
    q = hit.groupBy(*keys, "_name").agg(side(False).alias("_lo"), side(True).alias("_hi"), F.max("_n").alias("_n"), F.max("_p").alias("_p"))
    q = q.withColumn("_q", _interpolated(F.col("_n"), F.col("_p"), F.col("_lo"), F.col("_hi")))
    sums = [F.max("_n").alias(total)] if total else []
    return q.groupBy(*keys).agg(*sums, *[F.max(F.when(F.col("_name") == n, F.col("_q"))).alias(n) for n, _, _ in asks])


def _within(w: DataFrame, cells: DataFrame, group: list[str]) -> DataFrame:
    """Counts whose value lies in a cell, a part of a slice. Cells come from slices of more than ``RANKED`` values, so there
    are few: fewer than the counts divided by ``RANKED``, times the ranks asked of a group. They are broadcast, so the
    slice's counts stay where they are."""
    joined = _join_null_safe(w, F.broadcast(cells), [*group, "_s"])
    # the difference is exact, the sum may not be
    return joined.where((F.col("_v") >= F.col("_from")) & (F.col("_v") - F.col("_from") < F.col("_width")))


def _narrowed(w: DataFrame, group: list[str], big: DataFrame) -> DataFrame:
    """The part of each too large cell that holds its rank."""
    cell = [*group, "_s", "_from", "_width"]
    hit = _within(w, big.select(*cell).distinct(), group)
    step = F.greatest(F.col("_width") / PARTS, F.lit(TINY))
    hit = hit.withColumn("_part", F.col("_from") + F.floor((F.col("_v") - F.col("_from")) / step) * step)
    parts = hit.groupBy(*cell, "_part").agg(F.sum("_w").alias("_pc"), F.count(F.lit(1)).alias("_pk"))
    parts = parts.withColumn("_pb", F.sum("_pc").over(Window.partitionBy(*cell).orderBy("_part")) - F.col("_pc"))
    t = _join_null_safe(big, parts, cell).withColumn("_pb", F.col("_before") + F.col("_pb"))
    t = t.where((F.col("_rank") >= F.col("_pb")) & (F.col("_rank") < F.col("_pb") + F.col("_pc")))
    return t.withColumns({"_from": F.col("_part"), "_width": step, "_before": F.col("_pb"), "_k": F.col("_pk"),
                          "_deep": F.lit(True)}).drop("_part", "_pc", "_pk", "_pb")


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value,
                      quantiles: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles of ``value`` per group (NULLs ignored).

    Groups whose values are all NULL are absent from the result; join back
    with ``join_on_keys`` (left) to keep them with NULL quantiles.
    """
    return exact_quantiles_by(df, keys, {n: (value, p) for n, p in quantiles.items()})


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two group-level frames on null-safe key equality (grouping
    keeps NULL groups, so plain ``=`` would drop them)."""
    if not keys:
        return _single_row_join(left, right)
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"_rk_{k}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left").drop(*[f"_rk_{k}" for k in keys])


def _single_row_join(left: DataFrame, right: DataFrame) -> DataFrame:
    # Both sides are one-row global aggregates: attach right's columns as
    # scalar subqueries.
    return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])


def summarize(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
              medians: dict[str, object] | None = None) -> DataFrame:
    """``groupBy(keys).agg(aggs)`` plus exact medians per group, all in one pass over ``df``: what the aggregates need is
    counted beside the values."""
    if not medians:
        return df.groupBy(*keys).agg(*aggs)
    return exact_quantiles_by(df, keys, {n: (c, 0.5) for n, c in medians.items()}, aggs)


def global_quantiles(df: DataFrame, value, quantiles: dict[str, float]) -> DataFrame:
    """One-row frame of exact global quantiles of ``value``."""
    return grouped_quantiles(df, [], value, quantiles)


def scalar(df: DataFrame, expr: Column) -> Column:
    """A scalar-subquery column holding ``expr`` evaluated over ``df``'s single
    row (``df`` must be a global aggregate)."""
    return df.select(expr.alias("_s")).scalar()


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_rk_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"_rk_{k}" for k in keys])
