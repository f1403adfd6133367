"""M3: forests against a tree grown by hand and against the mean of their own trees."""

import random

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from estatelake.operators import forest, ml


def grown(rows, depth):
    """Best split by remaining squared error, thresholds halfway between neighbours; the mean in a leaf."""
    mean = sum(y for *_, y in rows) / len(rows)
    best = None
    for j in (0, 1):
        values = sorted({r[j] for r in rows})
        for lo, hi in zip(values, values[1:]):
            parts = [[r for r in rows if r[j] <= (lo + hi) / 2], [r for r in rows if r[j] > (lo + hi) / 2]]
            error = sum(sum((r[2] - sum(x[2] for x in p) / len(p)) ** 2 for r in p) for p in parts)
            if best is None or error < best[0] - 1e-9:
                best = (error, j, (lo + hi) / 2, parts)
    if depth == 0 or best is None or best[0] >= sum((r[2] - mean) ** 2 for r in rows) - 1e-12:
        return lambda r: mean
    _, j, cut, parts = best
    left, right = (grown(p, depth - 1) for p in parts)
    return lambda r: left(r) if r[j] <= cut else right(r)


def data(spark, n=28):
    rng = random.Random(4)
    rows = [(float(rng.randrange(12)), float(rng.randrange(9)), rng.gauss(0, 3)) for _ in range(n)]
    rows = [(a, b, 10 * (a > 5) + 4 * (b > 3) * (a <= 5) + y) for a, b, y in rows]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    return rows, VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_one_tree_is_the_tree_grown_by_hand(spark):
    rows, df = data(spark)
    for depth in (0, 1, 3):
        model = ml.make_regressor("rf", num_trees=1, max_depth=depth).setBootstrap(False).fit(df)
        want = grown(rows, depth)
        got = {(r["a"], r["b"]): r["__pred"] for r in model.transform(df).collect()}
        assert all(abs(got[r[0], r[1]] - want(r)) < 1e-6 for r in rows), depth


def test_a_forest_is_the_mean_of_its_trees(spark):
    _, df = data(spark, 60)
    model = ml.make_regressor("rf", num_trees=7, max_depth=4).fit(df)
    again = ml.make_regressor("rf", num_trees=7, max_depth=4).fit(df)
    for r, q in zip(model.transform(df).orderBy("a", "b", "label").collect(), again.transform(df).orderBy("a", "b", "label").collect()):
        assert abs(r["__pred"] - np.mean([t.predict(r["features"]) for t in model.trees])) < 1e-9 and r["__pred"] == q["__pred"]
    assert len(model.trees) == 7 and max(t.depth for t in model.trees) <= 4


def test_forests_are_fitted_in_tasks_by_rows_and_features(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(f"u{i}", f"p{i % 40}", rng.choice(["flat", None]), rng.choice([30.0, 55.0, None]), 1e5 + 1000 * (i % 40))
            for i in range(300)]
    df = spark.createDataFrame(rows, "url string, postal_code string, city string, surface_m2 double, price double").coalesce(1)
    num, cat = ml.select_feature_columns(df, "price")
    seen, make = [], ml.make_regressor

    def recorded(kind, **options):
        model = make(kind, **options)
        fit = model.fit
        model.fit = lambda data, *a: seen.append((data.rdd.getNumPartitions(), data.count())) or fit(data, *a)
        return model

    monkeypatch.setattr(ml, "make_regressor", recorded)
    results = []
    for task in (ml.FOREST_TASK, 300 * 42 // 3, 300 * 42 // 3):
        monkeypatch.setattr(ml, "FOREST_TASK", task)
        seen.clear()
        per = ml.cv_models(df, "price", ["rf"], num, cat, k=2, params={"rf": {"num_trees": 3, "max_depth": 4}})
        results.append(sorted((r["fold"], r["n"], round(r["rmse"], 6)) for r in per.collect()))
        assert sum(n for _, n in seen) == 300
        assert {p for p, _ in seen} == ({1} if task == 50_000_000 else {min(3, spark.sparkContext.defaultParallelism)})
    assert [r[:2] for r in results[0]] == [r[:2] for r in results[1]] and results[1] == results[2]
    d = ml.cut_lineage(df)
    parts = ml.spread(d, ["url", "price"], 5)
    assert parts.rdd.getNumPartitions() == 5 and sorted(parts.collect()) == sorted(d.select("url", "price").collect())
    assert [len(x) for x in parts.rdd.glom().collect()] == [60] * 5


def one_hot(spark, n=240, kinds=30):
    rng = random.Random(11)
    rows = [(f"p{rng.randrange(kinds)}", rng.choice(["flat", "house", None]), rng.choice([30.0, 55.0, 80.0, None]),
             float(rng.randrange(200)), rng.gauss(0, 1)) for _ in range(n)]
    rows = [(a, b, c, d, 12 + (int(a[1:]) % 5) + (b == "flat") * 2 + (c or 60) / 40 + d / 50 + y) for a, b, c, d, y in rows]
    df = spark.createDataFrame(rows, "postal_code string, city string, surface_m2 double, bathrooms double, label double")
    return df, Pipeline(stages=ml.preprocessing_stages(df, ["surface_m2", "bathrooms"], ["postal_code", "city"])).fit(df)


def test_without_draws_the_forest_is_sparks_forest(spark):
    df, prep = one_hot(spark)
    rows = prep.transform(df)
    options = dict(featuresCol="features", labelCol="label", predictionCol="__pred", seed=42, bootstrap=False,
                   featureSubsetStrategy="all", maxBins=16)
    for trees, depth, least in ((1, 6, 1), (2, 3, 9)):
        own = forest.SparseForest(numTrees=trees, maxDepth=depth, minInstancesPerNode=least, **options).fit(rows)
        spark_s = RandomForestRegressor(numTrees=trees, maxDepth=depth, minInstancesPerNode=least, **options).fit(rows)
        assert type(own) is type(spark_s) and own.numFeatures == spark_s.numFeatures
        assert [t.numNodes for t in own.trees] == [t.numNodes for t in spark_s.trees]
        # in a node of two cities either one's column cuts alike, so importances are those of the numbers
        assert np.allclose(own.featureImportances.toArray()[:2], spark_s.featureImportances.toArray()[:2], atol=1e-9)
        got, want = ([r["__pred"] for r in m.transform(rows).select("__pred").collect()] for m in (own, spark_s))
        assert np.allclose(got, want, atol=1e-9) and len(set(want)) > 5


def test_work_of_a_forest_follows_the_values_that_are_not_zero(spark, monkeypatch):
    seen, cut = [], forest.cut_lineage

    def recorded(df):
        seen.append(cut(df))
        return seen[-1]

    monkeypatch.setattr(forest, "cut_lineage", recorded)
    monkeypatch.setattr(forest, "BLOCK", 100)
    for kinds in (5, 200):
        df, prep = one_hot(spark, 300, kinds)
        model = ml.make_regressor("rf", num_trees=3, max_depth=4).fit(prep.transform(df.coalesce(1)))
        assert model.numFeatures > kinds * 0.7 and len(model.trees) == 3
        blocks = seen[-1].collect()
        assert sum(b["n"] for b in blocks) == 300 and max(b["n"] for b in blocks) <= 100
        assert max(len(b["features"]) / b["n"] for b in blocks) <= 4 * 4       # four columns, whatever their categories


def test_draws_of_a_forest(spark):
    ids = np.arange(20_000)
    w = forest.weights(ids, 42, 3, True)
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05 and (w == forest.weights(ids, 42, 3, True)).all()
    assert abs(np.corrcoef(w, forest.weights(ids, 42, 4, True))[0, 1]) < 0.03
    features = np.arange(900)
    drawn = [forest._hash(np.uint64(k), features) <= np.uint64(forest.drawn_below(k, 900, 300)) for k in (5, 6, 7)]
    assert [x.sum() for x in drawn] == [300] * 3 and 60 < (drawn[0] & drawn[1]).sum() < 140
    assert forest.find_thresholds(np.array([1.0, 2.0, 4.0]), np.array([1, 1, 1]), 5).tolist() == [1.5, 3.0]
    assert len(forest.find_thresholds(np.arange(1000.0), np.ones(1000), 31)) == 31


def test_a_saved_forest_scores_as_the_fitted_one(spark, tmp_path):
    df, _ = one_hot(spark)
    model = ml.fit_model(df, "label", "rf", ["surface_m2", "bathrooms"], ["postal_code", "city"], num_trees=4, max_depth=5)
    model.write().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    new = df.withColumn("postal_code", F.lit("never seen"))
    for rows in (df, new):
        a, b = ([r["prediction"] for r in ml.predict(m, rows).collect()] for m in (model, again))
        assert a == b and np.isfinite(a).all()
