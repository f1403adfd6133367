"""Hard negatives against plain integer arithmetic on all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from estatelake.llm import hard_negatives, queries
from estatelake.llm.oracles import OP12

SCHEMA = "vec_id long, embedding array<float>, label int, key long, score string, bucket long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def brute(rows, every=50):
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v], g) for i, v, g in rows
           if g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    use.sort(key=lambda r: (r[0] is None, r[0] or 0))
    out = Counter()
    for n, (i, v, g) in enumerate(use):
        if i is None or i % every:
            continue
        score = lambda u: sum(x * y for x, y in zip(u, v))
        ranked = sorted((-score(u), m, j, h) for m, (j, u, h) in enumerate(use) if m != n)
        for p in [r for r in ranked if r[3] == g][:5]:
            inside = [r for r in ranked if r[3] != g and 50 * -p[0] <= 100 * -r[0] <= 95 * -p[0]]
            for k, r in enumerate(inside[:3]):
                out[i, p[2], k + 1, r[2], -p[0], -r[0]] += 1
    return out


def vectors(seed, n=300, dims=7, spread=0.4, labels=4):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in rng.sample(range(1000), n):
        g = rng.randrange(labels) if rng.random() < 0.6 else 0
        rows.append((i, [c + rng.gauss(0.1, spread) for c in centre[g]], g))
    same = rows[0][1]
    rows += [(2000 + i, same, i % 3) for i in range(40)]                # one very common vector
    rows += [(3000, None, 1), (3050, same, None), (3100, [None] + same[1:], 1), (3150, [float("nan")] + same[1:], 1),
             (3200, [float("inf")] + same[1:], 2), (3250, [float("-inf")] + same[1:], 2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,spread,sizes", [(1, 0.4, {}), (2, 0.01, {"block_bytes": 4000, "anchor_bytes": 200}),
                                               (3, 40.0, {"block_bytes": 3000}), (4, 3e5, {"anchor_bytes": 300})])
def test_mine(spark, seed, spread, sizes):
    rows = vectors(seed, spread=spread)
    got = hard_negatives.mine(frame(spark, rows).repartition(4), **sizes)
    want = brute(rows)
    assert Counter(tuple(r) for r in got.collect()) == want and len(want) > 20


def test_mine_repeated_null_and_short(spark):
    rows = vectors(6, n=120)
    rows += [(50, rows[0][1], 1), (50, rows[1][1], 1), (None, rows[2][1], 1), (None, rows[2][1], 2), (100, [], 1), (150, [0.5], 2), (151, [0.5, 0.1], 3)]
    got = Counter(tuple(r) for r in hard_negatives.mine(frame(spark, rows)).collect())
    order = {id(r): n for n, r in enumerate(rows)}
    del order
    ids = Counter(r[0] for r in got.elements())
    want = brute(rows)
    # rows that repeat an id may swap places among equal scores; ids, ranks and scores stand
    assert got == want and ids


def test_mine_empty(spark):
    assert hard_negatives.mine(frame(spark, [])).count() == 0
    assert hard_negatives.mine(frame(spark, [(50, [0.1, 0.2], 1), (51, [0.3, 0.2], 2)])).count() == 0      # no positive
    assert hard_negatives.mine(frame(spark, [(51, [0.1], 1), (52, [0.3], 1)])).count() == 0                # no anchor


@pytest.mark.parametrize("lo,hi,dims", [(-3, 3, 5), (-136, 146, 64), (0, 0, 4), (-5000, 90000, 33), (-(1 << 24), 1 << 24, 16), (-(1 << 40), 1 << 30, 9),
                                        (10 ** 9, 10 ** 9 + 3, 6)])
def test_packed_scores_are_exact(lo, hi, dims):
    rng = random.Random(lo + hi)
    make = lambda n: [[rng.choice([lo, hi, rng.randint(lo, hi)]) for _ in range(dims)] for _ in range(n)]
    x, y = make(23), make(7)
    p = hard_negatives.Packing(lo, hi, dims)
    want = [[max(-(1 << 62), min(1 << 62, sum(a * b for a, b in zip(u, v)))) for u in x] for v in y]
    assert p.scores(np.array(x, np.int64), np.array(y, np.int64)).tolist() == want
    assert p._wide(np.array(x, np.int64), np.array(y, np.int64)).tolist() == want
    assert (p.fields > 1) == (dims * (hi - lo) ** 2 < 2 ** 26 and dims * max(abs(lo), abs(hi)) ** 2 < 2 ** 62)


def test_query_sql(spark):
    import duckdb
    from conftest import SF001
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF001}/embeddings.parquet')")
    cur = con.execute(OP12)
    got = queries.op12_hard_negatives(spark, SF001)
    assert sorted(c[0] for c in cur.description) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select([c[0] for c in cur.description]).collect()) == Counter(cur.fetchall())
