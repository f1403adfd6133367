"""Linear models on all folds from one pass: Gram subtraction.

Rows are sparse: a numeric feature holds its value or its missing mark, a
categorical one the number of its category or its missing mark, plus a constant
and the label. One aggregate sums the products of every two entries of a row, per
fold; that is X'X, X'y and y'y at once. A fold is trained on the total minus its own sums.

What preprocessing fits on the training rows needs no other pass either: medians and
modes come from value counts per fold, and filling a missing value is a linear
map of the entries (median times the missing mark; the missing mark moved to the mode's
category), as is scaling, so it is applied to the sums. Categories that occur only in
the held-out fold get weight 0, as an unknown category does.

The least-squares weights of smallest norm (scaled features) are found by conjugate
gradients on the sparse sums, which take any number of features; up to ``DENSE`` features by a direct solve.

Sizes: the sums have one entry per fold and pair of features that meet in a row, whatever the number of rows. They
go to the driver only up to ``MOST`` entries (about 0.1 GB); ``predictions`` returns None beyond that and callers
fit each fold apart. Weights (fewer than the sums) are broadcast for scoring.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .categories import encode, ranked
from .stats import quantiles_of_counts

MOST = 4_000_000
DENSE = 512


def _entry(i, j, v) -> Column:
    at = lambda x: F.lit(x).cast("long") if isinstance(x, int) else x
    return F.struct(at(i).alias("i"), at(j).alias("j"), v.alias("v"))


def _sums(d: DataFrame, m: int, q: int, const: int) -> DataFrame:
    """fold, i, j (i <= j), v: sums of the products of every two entries of a row. ``d``: fold, numbers _x0.., places of the
    categories or of their missing marks _s0.., _label. Products of numbers are columns of one aggregate, those of
    categories and numbers columns of one aggregate by category, and only two categories' are rows of their own."""
    x = [F.col(f"_x{j}") for j in range(m)]
    values = {j: F.coalesce(c, F.lit(0.0)) for j, c in enumerate(x)} | {m + j: F.when(c.isNull(), 1.0).otherwise(0.0) for j, c in enumerate(x)}
    values |= {const: F.lit(1.0), const + 1: F.col("_label")}
    places = sorted(values)
    names = {(i, j): f"_{a}_{b}" for a, i in enumerate(places) for b, j in enumerate(places) if a <= b}
    total = d.groupBy("fold").agg(*[F.sum(values[i] * values[j]).alias(n) for (i, j), n in names.items()])
    found = total.select("fold", F.explode(F.array(*[_entry(i, j, F.col(n)) for (i, j), n in names.items()])).alias("e"))
    if q:
        slots = [F.col(f"_s{j}") for j in range(q)]
        one = d.select("fold", *[v.alias(f"_{i}") for i, v in values.items()], F.explode(F.array(*slots)).alias("_s"))
        one = one.groupBy("fold", "_s").agg(*[F.sum(f"_{i}").alias(f"_{i}") for i in places])
        s = F.col("_s")
        each = [_entry(s, s, F.col(f"_{const}")), *[_entry(*((i, s) if i < const else (s, i)), F.col(f"_{i}")) for i in places]]
        found = found.unionByName(one.select("fold", F.explode(F.array(*each)).alias("e")))
    if q > 1:
        two = [F.struct(F.least(a, b).alias("i"), F.greatest(a, b).alias("j")) for n, a in enumerate(slots) for b in slots[n + 1:]]
        two = d.select("fold", F.explode(F.array(*two)).alias("e")).groupBy("fold", "e.i", "e.j").agg(F.count(F.lit(1)).cast("double").alias("v"))
        found = found.unionByName(two.select("fold", F.struct("i", "j", "v").alias("e")))
    return found.select("fold", "e.*").where("v <> 0")


class Sums:
    """X'X with the label as last column, of one set of rows: entries (i <= j, v)."""

    def __init__(self, i: np.ndarray, j: np.ndarray, v: np.ndarray, size: int):
        self.i, self.j, self.v, self.size = i, j, v, size
        self.off = i != j

    def times(self, x: np.ndarray) -> np.ndarray:
        out = np.bincount(self.i, self.v * x[self.j], self.size)
        return out + np.bincount(self.j[self.off], (self.v * x[self.i])[self.off], self.size)


class Design:
    """How weights of the filled and scaled features act on the raw entries. Raw: m numbers, m missing marks of numbers, q
    missing marks of categories, the categories, the constant, the label. Weights: m numbers, categories, constant."""

    def __init__(self, sums: Sums, m: int, q: int, medians: list[float], modes: list[int | None]):
        self.m, self.q, self.size = m, q, sums.size
        self.const, self.label = sums.size - 2, sums.size - 1
        self.medians, self.modes = np.array(medians, float), modes
        one = np.zeros(sums.size)
        one[self.const] = 1
        total = sums.times(one)
        n = max(total[self.const], 1)
        square = np.zeros(sums.size)
        same = ~sums.off
        square[sums.i[same]] = sums.v[same]
        mean = (total[:m] + self.medians * total[m:2 * m]) / n
        spread = (square[:m] + self.medians ** 2 * square[m:2 * m]) / n - mean ** 2
        self.mean, self.scale = mean, np.sqrt(np.where(spread > 1e-12 * (mean ** 2 + 1), spread, np.inf))   # constant: weight 0
        self.width = m + (self.const - 2 * m - q) + 1

    def raw(self, w: np.ndarray) -> np.ndarray:
        m, q = self.m, self.q
        u = np.zeros(self.size)
        u[:m] = w[:m] / self.scale
        u[m:2 * m] = self.medians * u[:m]
        u[2 * m + q:self.const] = w[m:-1]
        for c, mode in enumerate(self.modes):
            u[2 * m + c] = 0 if mode is None else u[mode]
        u[self.const] = w[-1] - (self.mean * u[:m]).sum()
        return u

    def back(self, u: np.ndarray) -> np.ndarray:
        """The transposed map."""
        m, q = self.m, self.q
        w = np.zeros(self.width)
        w[:m] = (u[:m] + self.medians * u[m:2 * m] - self.mean * u[self.const]) / self.scale
        w[m:-1] = u[2 * m + q:self.const]
        for c, mode in enumerate(self.modes):
            if mode is not None:
                w[m + mode - 2 * m - q] += u[2 * m + c]
        w[-1] = u[self.const]
        return w


def solve(sums: Sums, design: Design, tolerance: float = 1e-11, rounds: int = 5000) -> np.ndarray:
    """Raw weights (label's is 0) of the least-squares solution of smallest norm."""
    label = np.zeros(sums.size)
    label[design.label] = 1
    masked = lambda u: np.concatenate([u[:-1], [0.0]])
    goal = design.back(masked(sums.times(label)))
    act = lambda w: design.back(masked(sums.times(design.raw(w))))
    if design.width <= DENSE:
        a = np.array([act(e) for e in np.eye(design.width)])
        w = np.linalg.lstsq((a + a.T) / 2, goal, rcond=1e-11)[0]
        return design.raw(w)
    w = np.zeros(design.width)
    r = goal.copy()
    p, rr = r.copy(), r @ r
    stop = rr * tolerance ** 2
    for _ in range(rounds):
        if rr <= stop:
            break
        ap = act(p)
        step = rr / (p @ ap)
        w += step * p
        r -= step * ap
        new = r @ r
        p = r + new / rr * p
        rr = new
    return design.raw(w)


def predictions(df: DataFrame, target: str, num: Sequence[str], cat: Sequence[str], fold: Column, held: Sequence[int],
                log_target: bool = True) -> DataFrame | None:
    """fold, ``target``, prediction of the rows of every held-out fold, each by the model of all other rows; None when the
    sums are too many. ``df`` is read once."""
    m, q = len(num), len(cat)
    label = F.log1p(target) if log_target else F.col(target).cast("double")
    d = cut_lineage(df.where(F.col(target).isNotNull()).select(
        fold.cast("int").alias("fold"), F.col(target), label.alias("_label"), *[F.col(c).cast("double").alias(c) for c in num],
        *[F.col(c).cast("string").alias(c) for c in cat]))

    values = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("number"), F.lit(None).cast("string").alias("value")) for c in num]
    values += [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("number"), F.col(c).alias("value")) for c in cat]
    counts = d.select("fold", F.explode(F.array(*values)).alias("e")).select("fold", "e.*").where("number IS NOT NULL OR value IS NOT NULL")
    counts = cut_lineage(counts.groupBy("fold", "feature", "number", "value").agg(F.count(F.lit(1)).alias("n")))
    others = counts.withColumn("held", F.explode(F.array(*[F.lit(h) for h in held]))).where("held <> fold OR fold IS NULL")
    medians, modes = {}, {}
    if num:
        got = quantiles_of_counts(others.where("number IS NOT NULL"), ["held", "feature"], "number", "n", {"median": 0.5})
        medians = {(r["held"], r["feature"]): r["median"] for r in got.collect()}

    # numbers and missing marks first, then the categories
    base = 2 * m + q
    slots, n_categories = [], 0
    if cat:
        index = cut_lineage(ranked(counts.where("value IS NOT NULL").groupBy("feature", "value").agg(F.sum("n").alias("n"))))
        n_categories = index.count()
        best = others.where("value IS NOT NULL").groupBy("held", "feature", "value").agg(F.sum("n").alias("n")) \
            .groupBy("held", "feature").agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("value"))
        best = best.join(index.select("feature", "value", "number"), ["feature", "value"])
        modes = {(r["held"], r["feature"]): base + r["number"] for r in best.collect()}
        d = encode(d, cat, index, fill_mode=False, column="number")
        slots = [F.coalesce(F.col(f"{c}__i") + base, F.lit(2 * m + j)).cast("long").alias(f"_s{j}") for j, c in enumerate(cat)]
    const = base + n_categories
    d = cut_lineage(d.select("fold", target, "_label", *[F.col(c).alias(f"_x{j}") for j, c in enumerate(num)], *slots))

    sums = cut_lineage(_sums(d, m, q, const))
    if sums.count() > MOST:
        return None
    got = sums.toPandas()
    key, place = np.unique(got["i"].to_numpy() * (const + 2) + got["j"].to_numpy(), return_inverse=True)
    i, j, v, of = key // (const + 2), key % (const + 2), got["v"].to_numpy(), got["fold"].to_numpy()
    weights = []
    for h in held:
        # the training rows' sums: everything but the fold's own; summed, not subtracted, so nothing cancels
        train = Sums(i, j, np.bincount(place, np.where(of == h, 0.0, v), len(key)), const + 2)
        design = Design(train, m, q, [medians.get((h, c)) or 0.0 for c in num], [modes.get((h, c)) for c in cat])
        u = solve(train, design)
        weights += [(int(h), int(n), float(u[n])) for n in np.flatnonzero(u[:-1])]
    spark = d.sparkSession
    weights = spark.createDataFrame(weights, "held int, i long, w double")
    # a row's prediction is a sum of its own entries' weights: broadcast joins, at most as many weights as sums
    few = {*range(2 * m), const}
    dense = weights.where(F.col("i").isin(list(few))).groupBy("held").agg(F.map_from_entries(F.collect_list(F.struct("i", "w"))).alias("_w"))
    held_folds = spark.createDataFrame([(int(h),) for h in held], "held int").join(dense, "held", "left")
    out = d.join(F.broadcast(held_folds), F.col("fold") == F.col("held")).drop("held")
    weight = lambda i: F.coalesce(F.element_at("_w", F.lit(i).cast("long")), F.lit(0.0))
    total = weight(const)
    for j in range(m):
        x = F.col(f"_x{j}")
        total = total + F.when(x.isNotNull(), x * weight(j)).otherwise(weight(m + j))
    slotted = weights.where(~F.col("i").isin(list(few)))
    for j in range(q):
        mine = slotted.select(F.col("held").alias(f"_h{j}"), F.col("i").alias(f"_i{j}"), F.col("w").alias(f"_w{j}"))
        out = out.join(F.broadcast(mine), (F.col("fold") == F.col(f"_h{j}")) & (F.col(f"_s{j}") == F.col(f"_i{j}")), "left")
        total = total + F.coalesce(f"_w{j}", F.lit(0.0))
    return out.select("fold", target, (F.expm1(total) if log_target else total).alias("prediction"))
