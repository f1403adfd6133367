"""Linear models by Gram subtraction against explicit matrices; category dictionaries against plain counting."""

import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelake.operators import categories, gram, ml

NUM, CAT = ["a", "b", "void"], ["p", "q"]
SCHEMA = "y double, a double, b double, void double, p string, q string, fold int, i long, label string"


def rows(seed, n=240):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, p = rng.gauss(2000, 30), rng.choice(["x", "y", "z", f"rare{rng.randrange(60)}"])
        q = rng.choice(["u", "v", None])
        y = max(1.0, 50 + 0.2 * a + {"x": 5, "y": 9}.get(p, 0) + rng.gauss(0, 3))
        out.append((y if rng.random() < 0.97 else None, a if rng.random() < 0.8 else None, rng.choice([None, 1.0, 2.0]), None, p if rng.random() < 0.9 else None,
                    q, rng.randrange(3), i, "clash"))
    return out


def brute(data, log):
    """Filled, scaled, one-hot, least squares of smallest norm, fold by fold."""
    data = [r for r in data if r[0] is not None]
    out = {}
    for h in range(3):
        train, test = [r for r in data if r[6] != h], [r for r in data if r[6] == h]
        fill = [statistics.median(v) if (v := [r[j] for r in train if r[j] is not None]) else 0.0 for j in (1, 2, 3)]
        mode = [min(Counter(r[j] for r in train if r[j] is not None).items(), key=lambda kv: (-kv[1], kv[0]))[0] for j in (4, 5)]
        names = [sorted({r[j] for r in train if r[j] is not None}) for j in (4, 5)]

        def line(r):
            x = [r[j] if r[j] is not None else fill[j - 1] for j in (1, 2, 3)]
            return x, [float((r[j] if r[j] is not None else mode[j - 4]) == v) for j in (4, 5) for v in names[j - 4]]

        numbers = np.array([line(r)[0] for r in train])
        mean, sd = numbers.mean(0), numbers.std(0)
        sd[sd < 1e-9] = np.inf
        full = lambda r: np.concatenate([(np.array(line(r)[0]) - mean) / sd, line(r)[1], [1.0]])  # noqa: E731, B023
        goal = np.array([math.log1p(r[0]) if log else r[0] for r in train])
        w = np.linalg.lstsq(np.array([full(r) for r in train]), goal, rcond=None)[0]
        for r in test:
            out[r[7]] = math.expm1(full(r) @ w) if log else full(r) @ w
    return out


@pytest.mark.parametrize("log,dense", [(True, 512), (False, 0)])
def test_predictions_equal_explicit_matrices(spark, monkeypatch, log, dense):
    monkeypatch.setattr(gram, "DENSE", dense)       # 0: conjugate gradients
    data = rows(1)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = gram.predictions(df, "y", NUM, CAT, F.col("fold"), [0, 1, 2], log).collect()
    want = brute(data, log)
    have = sorted((r["fold"], r["y"], r["prediction"]) for r in got)
    expect = sorted((r[6], r[0], want[r[7]]) for r in data if r[7] in want)
    assert len(have) == len(expect) == len(want)
    for (f1, y1, p1), (f2, y2, p2) in zip(have, expect):
        assert (f1, y1) == (f2, y2) and abs(p1 - p2) < 1e-6 * max(1, abs(p2))


def test_holdout_and_fallback(spark, monkeypatch):
    df = spark.createDataFrame(rows(2), SCHEMA)
    one = ml.cross_validate(df, "y", "linear", ["a", "b"], ["q"], k=3, fold_col="fold").orderBy("fold").collect()
    monkeypatch.setattr(gram, "MOST", 0)
    apart = ml.cross_validate(df, "y", "linear", ["a", "b"], ["q"], k=3, fold_col="fold").orderBy("fold").collect()
    assert all(abs(x["rmse"] - z["rmse"]) < 0.02 * z["rmse"] and x["n"] == z["n"] for x, z in zip(one, apart)) and len(one) == len(apart) == 3


def test_category_index(spark):
    rng = random.Random(3)
    data = [(i, f"c{min(rng.randrange(400), rng.randrange(400))}" if rng.random() < 0.9 else None, rng.choice(["h", "h", "k", None])) for i in range(3000)]
    df = spark.createDataFrame(data, "i long, big string, small string").repartition(6)
    index = categories.category_index(df, ["big", "small"])
    want = {}
    for c, j in (("big", 1), ("small", 2)):
        ranked = sorted(Counter(r[j] for r in data if r[j] is not None).items(), key=lambda kv: (-kv[1], kv[0]))
        want |= {(c, v): (n, k) for k, (v, n) in enumerate(ranked)}
    got = index.collect()
    assert {(r["feature"], r["value"]): (r["n"], r["index"]) for r in got} == want
    assert sorted(r["number"] for r in got) == list(range(len(want)))
    out = categories.encode(df.unionByName(spark.createDataFrame([(9999, "new", None)], df.schema)), ["big", "small"], index)
    coded = {r["i"]: (r["big__i"], r["small__i"]) for r in out.collect()}
    assert len(coded) == 3001 and coded[9999] == (None, 0)
    assert all(coded[i] == (want["big", b][1] if b else 0, want["small", s][1] if s else 0) for i, b, s in data)
    assert categories.category_index(df.limit(0), ["big"]).count() == 0
