"""Exact quantiles: both ways of selecting ranks, narrow ranges, awkward values, counts that are added up."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelake.operators import stats


def values(seed):
    rng = random.Random(seed)
    near = [float(np.nextafter(2.0 ** k, s)) for k in (-3, 0, 1, 10, 20) for s in (-math.inf, math.inf)]
    out = [("narrow", 1_000_000 + rng.random() * 900) for _ in range(3000)]
    out += [("edges", rng.choice(near + [0.0, -0.0, 1e300, -1e300, 5e-324] + [-x for x in near])) for _ in range(700)]
    out += [("few", rng.choice([-5.5, 3.0, 3.0, 8.25])) for _ in range(100)] + [("one", 7.5), ("none", None), (None, 2.0), (None, 9.0), (None, None)]
    out += [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 9)) for _ in range(2000)] + [("big", 1e15 + rng.randrange(3000)) for _ in range(2500)]
    rng.shuffle(out)
    return out


PROBABILITIES = {"q05": 0.05, "med": 0.5, "q95": 0.95, "top": 1.0, "low": 0.0}


def want(rows):
    groups = {}
    for g, v in rows:
        groups.setdefault(g, [])
        if v is not None:
            groups[g].append(v)
    out = {}
    for g, v in groups.items():
        v.sort()
        for n, p in PROBABILITIES.items():
            pos = (len(v) - 1) * p
            lo, hi = math.floor(pos), math.ceil(pos)
            out[g, n] = None if not v else v[lo] if lo == hi else (hi - pos) * v[lo] + (pos - lo) * v[hi]
    return out


@pytest.mark.parametrize("direct,ranked", [(1 << 20, 1 << 16), (0, 1 << 16), (0, 20), (0, 1)])
def test_quantiles(spark, monkeypatch, direct, ranked):
    monkeypatch.setattr(stats, "DIRECT", direct)
    monkeypatch.setattr(stats, "RANKED", ranked)
    rows = values(1)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = stats.exact_quantiles_by(df, ["g"], {n: ("v", p) for n, p in PROBABILITIES.items()}, [F.count(F.lit(1)).alias("n")]).collect()
    assert {(r["g"], n): r[n] for r in got for n in PROBABILITIES} == want(rows)
    assert {r["g"]: r["n"] for r in got} == {g: sum(x == g for x, _ in rows) for g in {g for g, _ in rows}}
    bare = stats.exact_quantiles_by(df, ["g"], {"med": ("v", 0.5)}).collect()
    assert {r["g"]: r["med"] for r in bare} == {g: v for (g, n), v in want(rows).items() if n == "med" and v is not None}


def test_narrow_values_do_not_meet_in_one_task(spark, monkeypatch):
    """Values between 1,000,000 and 1,000,900 share their nine leading bits; the cell that is ranked stays small."""
    monkeypatch.setattr(stats, "DIRECT", 0)
    monkeypatch.setattr(stats, "RANKED", 40)
    rows = [v for g, v in values(2) if g == "narrow"]
    df = spark.createDataFrame([(v,) for v in rows], "v double")
    assert df.select(stats._slice(F.col("v"))).distinct().count() == 1
    seen, within = [], stats._within
    monkeypatch.setattr(stats, "_within", lambda w, cells, group: seen.append(out := within(w, cells, group)) or out)
    got = stats.global_quantiles(df, "v", {"med": 0.5}).first()["med"]
    assert got == want([("x", v) for v in rows])["x", "med"]
    assert [d.count() for d in seen][0] == len(set(rows)) and seen[-1].count() <= 2 * 40


def test_slices_never_decrease(spark):
    v = sorted({v for _, v in values(3) if v is not None})
    s = [r[0] for r in spark.createDataFrame([(x,) for x in v], "v double").select(stats._slice(F.col("v"))).collect()]
    assert s == sorted(s) and all(a <= b for a, b in zip(s, v))


def test_counts_add_up(spark):
    rows = values(4)
    df = spark.createDataFrame(rows, "g string, v double")
    parts = [p.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c")) for p in df.randomSplit([0.3, 0.3, 0.4], 5)]
    counts = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = {r["g"]: (r["n"], r["med"]) for r in stats.quantiles_of_counts(counts, ["g"], "v", "c", {"med": 0.5}, "n").collect()}
    assert got == {g: (sum(x == g and v is not None for x, v in rows), v) for (g, n), v in want(rows).items() if n == "med" and v is not None}


def test_only_large_groups_are_cut_into_slices(spark, monkeypatch):
    monkeypatch.setattr(stats, "DIRECT", 0)
    monkeypatch.setattr(stats, "RANKED", 40)
    sliced, by_slices = [], stats._by_slices

    def spy(w, keys, *rest):
        sliced.extend(r[0] for r in w.select(*keys).distinct().collect())
        return by_slices(w, keys, *rest)
    monkeypatch.setattr(stats, "_by_slices", spy)
    rng = random.Random(3)
    rows = [(g, float(rng.randrange(10 ** 6)), rng.randrange(1, 4)) for g, k in (("a", 30), (None, 25), ("large", 90), (None, 10)) for _ in range(k)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    got = {(r["g"], n): r[n] for r in stats.quantiles_of_counts(df, ["g"], "v", "n", PROBABILITIES, "total").collect() for n in [*PROBABILITIES, "total"]}
    right = want([(g, v) for g, v, n in rows for _ in range(n)])
    assert sliced == ["large"] and {k: v for k, v in got.items() if k[1] != "total"} == pytest.approx(right)
    assert {g: got[g, "total"] for g in ("a", None, "large")} == {g: sum(n for x, _, n in rows if x == g) for g in ("a", None, "large")}
    sliced.clear()
    stats.quantiles_of_counts(df.where("g = 'a' OR g IS NULL"), ["g"], "v", "n", PROBABILITIES).collect()
    assert not sliced
