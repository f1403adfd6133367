"""What one task holds must not grow with the input."""

from estatelake.sources import elements, pages

HTML = "<h1>Flat {0}</h1><table><tr><th>Bedrooms<td>{0}</table><dl><dt>City<dd>Gent</dl><div class='price'>EUR {0}50,000</div>" + "<p>text</p>" * 20


def test_tasks_for_tags_grow_with_the_pages(spark, monkeypatch):
    rows = [(i, f"https://x.example/{i}", HTML.format(i % 9)) for i in range(300)] + [(None, None, None), (777, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    read = lambda: (sorted(map(str, elements.page_elements(df, classes=("price",)).collect())),
                    sorted(map(str, pages.label_pairs(df).collect())))
    want = read()
    assert elements.page_elements(df.limit(0)).count() == 0
    monkeypatch.setattr(elements, "PART", 20_000)
    tasks = elements.page_elements(df, classes=("price",)).rdd.getNumPartitions()
    size = sum(len(r[2]) + elements.TAG * r[2].count("<") for r in rows if r[2])
    assert tasks == -(-size // 20_000) > 30
    assert read() == want


def test_sums_of_products_need_few_rows(spark, monkeypatch):
    """X'X of sparse rows against numpy; products with a number are no rows of their own, nor are predictions joined by row."""
    import random

    import numpy as np
    from pyspark.sql import functions as F

    from estatelake.operators import gram

    rng = random.Random(6)
    m, q, const = 2, 2, 2 * 2 + 2 + 5
    rows = [(rng.randrange(3), rng.choice([None, rng.gauss(5, 2)]), rng.choice([None, 1.0, 0.0]), rng.choice([4, 6, 7, 8]), rng.choice([5, 9, 10]), rng.gauss(0, 1))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "fold int, _x0 double, _x1 double, _s0 long, _s1 long, _label double")
    want = np.zeros((3, const + 2, const + 2))
    for f, *x, a, b, y in rows:
        v = np.zeros(const + 2)
        for j, value in enumerate(x):
            v[m + j if value is None else j] = 1.0 if value is None else value
        v[[a, b, const]] = 1.0
        v[const + 1] = y
        want[f] += np.outer(v, v)
    have = np.zeros_like(want)
    for r in gram._sums(df, m, q, const).collect():
        assert r["i"] <= r["j"] and have[r["fold"], r["i"], r["j"]] == 0
        have[r["fold"], r["i"], r["j"]] = have[r["fold"], r["j"], r["i"]] = r["v"]
    assert np.allclose(have, want, atol=1e-9)

    data = spark.createDataFrame([(i, i % 3, float(i % 7), f"c{i % 4}", 3.0 + i % 5) for i in range(60)], "i long, fold int, a double, p string, y double")
    out = gram.predictions(data, "y", ["a"], ["p"], F.col("fold"), [0, 1, 2])
    assert out.count() == 60
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate [_row" not in plan
