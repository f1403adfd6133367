"""Model preparation, training, evaluation, registry and batch scoring
(M1–M8, A14, A15, A17) with Spark ML.

* Fitted statistics (median per numeric feature, most frequent value per
  categorical) are computed exactly with distributed aggregations — all
  columns stacked into one long ``(feature, value)`` frame, so one job fits
  every column — and stored in the model as a ``SQLTransformer`` fill step,
  so the whole preprocessing saves and loads as one ``PipelineModel``.
* Unknown categories at scoring time become the all-zero one-hot vector
  (``StringIndexer(handleInvalid='keep')`` puts them in the last bucket,
  which ``OneHotEncoder(dropLast=True)`` drops).
* Folds and hold-out splits are a deterministic hash of a key column
  (``pmod(xxhash64(key, seed), k)``): no shuffle, reproducible, and the
  same row always lands in the same fold.
* Metrics are plain SQL aggregates over the prediction frame; r2 is
  1 − SSE/SST per fold (not ``regr_r2``, which is a squared correlation).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.regression import LinearRegression
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocab
from ..session import cut_lineage
from . import gram
from .forest import SparseForest
from .stats import grouped_quantiles

LEAKAGE = {"price": ["price_per_m2"], "price_per_m2": ["price"]}

#: Rows times one-hot features that one task of a forest takes.
FOREST_TASK = 50_000_000


# M1 -------------------------------------------------------------------------
def select_feature_columns(df: DataFrame, target: str) -> tuple[list[str], list[str]]:
    """Default numeric and categorical features present in ``df``, minus the
    columns that would leak the target."""
    deny = set(LEAKAGE.get(target, [])) | {target}
    num = [c for c in vocab.NUMERIC_FEATURES if c in df.columns and c not in deny]
    cat = [c for c in vocab.CATEGORICAL_FEATURES if c in df.columns and c not in deny]
    return num, cat


# A15 ------------------------------------------------------------------------
def _long(df: DataFrame, cols: Sequence[str], t: str) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"),
                                                  F.col(c).cast(t).alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*")


def median_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, median) — exact interpolated median per column, NULLs
    ignored, all columns in one job."""
    return grouped_quantiles(_long(df, cols, "double"), ["feature"], F.col("value"), {"median": 0.5})


def mode_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, mode) — most frequent non-NULL value per column, ties
    broken to the smallest value."""
    counts = _long(df, cols, "string").where(F.col("value").isNotNull()) \
        .groupBy("feature", "value").count()
    return counts.groupBy("feature").agg(
        F.min_by("value", F.struct((-F.col("count")).alias("n"), F.col("value"))).alias("mode"))


def fitted_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    if not cols:
        return {}
    got = {r["feature"]: r["median"] for r in median_table(df, cols).collect()}
    return {c: got.get(c) for c in cols}


def fitted_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    if not cols:
        return {}
    got = {r["feature"]: r["mode"] for r in mode_table(df, cols).collect()}
    return {c: got.get(c) for c in cols}


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


# M2 -------------------------------------------------------------------------
def preprocessing_stages(train: DataFrame, num: Sequence[str], cat: Sequence[str],
                         one_hot: bool = True) -> list:
    """Median-impute + standardise numerics; mode-impute + one-hot
    categoricals; assemble into ``features``. With ``one_hot=False`` the
    indexed categoricals go in as nominal features (tree splits on category
    sets; needs ``maxBins`` ≥ categories, which Spark also caps at the
    number of training rows)."""
    med, mode = fitted_medians(train, num), fitted_modes(train, cat)
    fills = []
    for c in num:
        m = med[c]
        fills.append(f"COALESCE(CAST(`{c}` AS DOUBLE), {repr(float(m)) if m is not None else 'CAST(NULL AS DOUBLE)'}) AS `{c}__f`")
    for c in cat:
        m = mode[c]
        fills.append(f"COALESCE(CAST(`{c}` AS STRING), {_sql_str(m) if m is not None else 'CAST(NULL AS STRING)'}) AS `{c}__f`")
    stages: list = [SQLTransformer(statement="SELECT *, " + ", ".join(fills) + " FROM __THIS__")]
    parts = []
    if num:
        stages += [VectorAssembler(inputCols=[f"{c}__f" for c in num], outputCol="__num",
                                   handleInvalid="keep"),
                   StandardScaler(inputCol="__num", outputCol="__num_s", withMean=True, withStd=True)]
        parts.append("__num_s")
    if cat:
        stages += [StringIndexer(inputCols=[f"{c}__f" for c in cat], outputCols=[f"{c}__i" for c in cat],
                                 handleInvalid="keep", stringOrderType="frequencyDesc"),
                   ]
        if one_hot:
            stages.append(OneHotEncoder(inputCols=[f"{c}__i" for c in cat],
                                        outputCols=[f"{c}__o" for c in cat],
                                        dropLast=True, handleInvalid="keep"))
            parts += [f"{c}__o" for c in cat]
        else:
            parts += [f"{c}__i" for c in cat]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


# M3 -------------------------------------------------------------------------
def forest_tasks(df: DataFrame, num: Sequence[str], cat: Sequence[str]) -> int:
    """Tasks a forest on ``df`` needs: by rows times one-hot features, which its sums may come to, not by the bytes of the
    narrow rows. At most one per core: every task ships sums of its own for every open node."""
    sizes = df.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(c).alias(f"_{j}") for j, c in enumerate(cat)]).first()
    numbers = sizes["n"] * (len(num) + sum(sizes[f"_{j}"] for j in range(len(cat))))
    return max(1, min(df.sparkSession.sparkContext.defaultParallelism, -(-numbers // FOREST_TASK)))


def spread(df: DataFrame, cols: Sequence[str], tasks: int) -> DataFrame:
    """``cols`` of the rows of ``df`` in ``tasks`` parts of the same length and a fixed order (a forest draws its rows by
    part and place); ``df`` itself, which must be materialised, when it has that many parts."""
    if df.rdd.getNumPartitions() >= tasks:
        return df
    return cut_lineage(df.select(*cols).repartition(tasks).sortWithinPartitions(*cols))


def make_regressor(kind: str, label: str = "label", num_trees: int = 400, max_depth: int = 30,
                   seed: int = 42, max_bins: int = 32, solver: str = "normal"):
    """'linear' (ordinary least squares by ``solver``: "normal" is exact and takes 4,096 features, "l-bfgs"
    any number of one-hot ones) or 'rf' (random forest; Spark allows depths up to 30)."""
    if kind == "linear":
        return LinearRegression(featuresCol="features", labelCol=label, predictionCol="__pred",
                                regParam=0.0, elasticNetParam=0.0, solver=solver)
    if kind == "rf":
        if max_depth > 30:
            raise ValueError("Spark forests are at most 30 levels deep")
        # Deep trees: a large node-group budget means far fewer passes over
        # the data per tree level; node ids are cached between levels.
        return SparseForest(featuresCol="features", labelCol=label, predictionCol="__pred",
                            numTrees=num_trees, maxDepth=max_depth, seed=seed,
                            maxBins=max_bins, maxMemoryInMB=1024, cacheNodeIds=True,
                            checkpointInterval=10)
    raise ValueError(kind)


def fit_model(train: DataFrame, target: str, kind: str, num: Sequence[str], cat: Sequence[str],
              log_target: bool = True, **kw) -> PipelineModel:
    """Preprocessing + regressor fitted on ``train``; the label is
    ``log1p(target)`` when ``log_target``."""
    t = train.where(F.col(target).isNotNull())
    t = t.withColumn("label", F.log1p(target) if log_target else F.col(target).cast("double"))
    if kind == "rf":
        t = cut_lineage(t)
        t = spread(t, [target, "label", *num, *cat], forest_tasks(t, num, cat))
    stages = preprocessing_stages(t, num, cat) + [make_regressor(kind, **kw)]
    return Pipeline(stages=stages).fit(t)


def predict(model: PipelineModel, df: DataFrame, log_target: bool = True,
            out: str = "prediction") -> DataFrame:
    p = model.transform(df)
    pred = F.expm1("__pred") if log_target else F.col("__pred")
    keep = [c for c in df.columns]
    return p.select(*keep, pred.alias(out))


# M4 / M5 --------------------------------------------------------------------
def hash_fold(key: Column | str, k: int, seed: int = 42) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(k)).cast("int")


def fold_metrics(pred: DataFrame, y: str, yhat: str = "prediction", fold: str = "fold") -> DataFrame:
    """Rmse, mae, mape (denominator clipped at 1e-9) and r2 per fold."""
    err = F.col(y) - F.col(yhat)
    per = pred.groupBy(fold).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(F.abs(err) / F.greatest(F.abs(F.col(y)), F.lit(1e-9))).alias("mape"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"),
        F.count(F.lit(1)).alias("n"))
    return per.select(fold, "rmse", "mae", "mape", (F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"),
                      "n")


def mean_metrics(per_fold: DataFrame) -> DataFrame:
    """Mean of the fold metrics, total n."""
    return per_fold.agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"),
                        F.avg("mape").alias("mape"), F.avg("r2").alias("r2"), F.sum("n").alias("n"))


def cv_models(df: DataFrame, target: str, kinds: Sequence[str], num: Sequence[str],
              cat: Sequence[str], k: int = 5, fold_col: str | None = None, key: str = "url",
              seed: int = 42, log_target: bool = True,
              params: dict[str, dict] | None = None, parallelism: int = 5) -> DataFrame:
    """M4 for several model kinds at once. Linear models of all folds come from one pass by Gram subtraction
    (``gram``; not with a ``solver`` of Spark's). For other kinds the preprocessing is
    fitted once per fold on the training rows and shared by every regressor; the
    transformed training fold is cached for the fits. Returns per-fold
    metrics with a ``model`` column; metrics are on the original scale."""
    params = params or {}
    fold = F.col(fold_col).cast("int") if fold_col else hash_fold(key, k, seed)
    done: dict[str, DataFrame] = {}
    if "linear" in kinds and "solver" not in params.get("linear", {}):
        got = gram.predictions(df, target, num, cat, fold, range(k), log_target)
        if got is not None:
            done["linear"] = got
    kinds = [x for x in kinds if x not in done]
    d = df.where(F.col(target).isNotNull())
    d = d.withColumn("fold", fold)
    if not kinds:
        return _all_fold_metrics(done, target)
    d = cut_lineage(d)      # k folds re-read it many times: materialise once, reliably
    tasks = forest_tasks(d, num, cat) if "rf" in kinds else 1
    d = spread(d, ["fold", target, *num, *cat], tasks)
    label = F.log1p(target) if log_target else F.col(target).cast("double")

    def one_fold(i: int) -> dict[str, DataFrame]:
        train = d.where(F.col("fold") != i).withColumn("label", label)
        prep = Pipeline(stages=preprocessing_stages(train, num, cat)).fit(train)
        tr = prep.transform(train).select("features", "label").cache()
        te = prep.transform(d.where(F.col("fold") == i))
        out = F.expm1("__pred") if log_target else F.col("__pred")
        got = {}
        for kind in kinds:
            model = make_regressor(kind, **_regressor_options(kind, params.get(kind, {}))).fit(tr)
            got[kind] = model.transform(te).select("fold", F.col(target), out.alias("prediction"))
        tr.unpersist()
        return got

    # Folds are independent fits: run them concurrently from driver threads
    # (as CrossValidator's ``parallelism`` does) so small per-fold jobs share
    # the cluster instead of queueing one after another. Folds that fill the
    # cores by themselves go one by one.
    cores = d.sparkSession.sparkContext.defaultParallelism
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, k, -(-cores // tasks) if tasks > 1 else k))) as pool:
        fold_preds = list(pool.map(one_fold, range(k)))
    preds = dict(done)
    for got in fold_preds:
        for kind, p in got.items():
            preds[kind] = p if kind not in preds else preds[kind].unionByName(p)
    return _all_fold_metrics(preds, target)


def _regressor_options(kind: str, options: dict) -> dict:
    """A linear model that Gram subtraction left over has too many features for the normal equations."""
    return {"solver": "l-bfgs", **options} if kind == "linear" else options


def _all_fold_metrics(preds: dict[str, DataFrame], target: str) -> DataFrame:
    per = None
    for kind, p in preds.items():
        m = fold_metrics(p, target).withColumn("model", F.lit(kind))
        per = m if per is None else per.unionByName(m)
    return per


def cross_validate(df: DataFrame, target: str, kind: str, num: Sequence[str], cat: Sequence[str],
                   k: int = 5, fold_col: str | None = None, key: str = "url", seed: int = 42,
                   log_target: bool = True, **kw) -> DataFrame:
    """M4: k-fold CV with a log target; metrics on the original scale.
    Returns per-fold metrics (``mean_metrics`` averages them)."""
    per = cv_models(df, target, [kind], num, cat, k, fold_col, key, seed, log_target, {kind: kw})
    return per.drop("model")


def holdout(df: DataFrame, target: str, kind: str, num: Sequence[str], cat: Sequence[str],
            split_col: str | None = None, key: str = "url", seed: int = 42, test_frac: int = 2,
            log_target: bool = False, **kw) -> DataFrame:
    """M5: 80/20 hold-out (hash split: bucket of 10 < ``test_frac`` is test);
    r2 and mae on the test rows. Linear models by one pass (``gram``)."""
    d = df.where(F.col(target).isNotNull())
    b = F.col(split_col).cast("int") if split_col else hash_fold(key, 10, seed)
    if kind == "linear" and "solver" not in kw:
        p = gram.predictions(d, target, num, cat, F.when(b < test_frac, 0).otherwise(1), [0], log_target)
        if p is not None:
            return fold_metrics(p, target).select("r2", "mae", "n")
        kw = _regressor_options(kind, kw)
    d = d.withColumn("_b", b)
    m = fit_model(d.where(F.col("_b") >= test_frac), target, kind, num, cat, log_target, **kw)
    p = predict(m, d.where(F.col("_b") < test_frac), log_target).withColumn("fold", F.lit(0))
    return fold_metrics(p, target).select("r2", "mae", "n")


# M7 -------------------------------------------------------------------------
class Registry:
    """Versioned models on shared storage: ``<root>/<kind>_<target>_<ts>``
    plus an append-only manifest table (kind, target, ts, path, metrics,
    target_is_log). Latest per target = ``max_by(path, ts)``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def save(self, model: PipelineModel, kind: str, target: str, metrics: dict,
             target_is_log: bool, extra: dict | None = None) -> str:
        # microseconds, and never at or before the newest version: order of saving is order of versions
        ts = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
        newest = self._newest_ts()
        if newest and ts <= newest:
            after = _dt.datetime.strptime(newest, "%Y%m%d_%H%M%S_%f") + _dt.timedelta(microseconds=1)
            ts = after.strftime("%Y%m%d_%H%M%S_%f")
        # two writers that took the same moment still write folders of their own
        path = f"{self.root}/{kind}_{target}_{ts}_{uuid.uuid4().hex[:8]}"
        model.write().overwrite().save(path)
        row = [(kind, target, ts, path, json.dumps(metrics, default=float), target_is_log,
                json.dumps(extra or {}))]
        (self.spark.createDataFrame(row, "kind string, target string, ts string, path string, "
                                         "metrics string, target_is_log boolean, extra string")
             .write.mode("append").parquet(f"{self.root}/_manifest"))
        return path

    def _newest_ts(self) -> str | None:
        try:
            return self.manifest().agg(F.max("ts")).first()[0]
        except AnalysisException as e:   # nothing saved yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/_manifest")

    def latest(self, target: str) -> DataFrame:
        """One row (path, target_is_log) of the newest model for ``target``."""
        m = self.manifest().where(F.col("target") == target)
        return m.agg(F.max_by("path", "ts").alias("path"),
                     F.max_by("target_is_log", "ts").alias("target_is_log"))


# A17, M6 --------------------------------------------------------------------
def best_model(scores: DataFrame) -> DataFrame:
    """The model with the lowest rmse (the smaller name on a tie), one row."""
    return scores.agg(F.min_by("model", F.struct("rmse", "model")).alias("best"))


def train_and_select(df: DataFrame, target: str, registry: Registry | None = None,
                     kinds: Sequence[str] = ("linear", "rf"), k: int = 5, key: str = "url",
                     solver: str = "l-bfgs", **kw) -> DataFrame:
    """CV every model kind, choose the lowest mean rmse (A17), fit it on all
    rows with the same log target, persist it. Returns the metrics table
    (one row per kind, ``chosen`` flag)."""
    d = cut_lineage(df.where(F.col(target).isNotNull()))     # every model kind, and the chosen one again, reads it
    num, cat = select_feature_columns(d, target)
    per = cv_models(d, target, kinds, num, cat, k=k, key=key, params={"rf": kw})
    rows = per.groupBy("model").agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"),
                                    F.avg("mape").alias("mape"), F.avg("r2").alias("r2"),
                                    F.sum("n").alias("n"))
    rows = rows.cache()
    best = best_model(rows).first()["best"]
    if registry is not None:
        model = fit_model(d, target, best, num, cat, True,
                          **(kw if best == "rf" else {"solver": solver}))
        metrics = {r["model"]: r.asDict() for r in rows.collect()}
        registry.save(model, best, target, metrics, True, {"chosen": best})
    return rows.withColumn("chosen", F.col("model") == F.lit(best))


# M8 -------------------------------------------------------------------------
def auto_predict(requests: DataFrame, registry: Registry) -> DataFrame:
    """Batch scoring with model routing: rows with a surface use the newest
    price model, rows without use the newest €/m² model; either falls back
    to the other when one is missing. €/m² predictions with a surface also
    get ``derived_price``."""
    def newest(target):
        r = registry.latest(target).first()
        return (r["path"], bool(r["target_is_log"])) if r and r["path"] else None

    price_m, ppm2_m = newest("price"), newest("price_per_m2")
    if not price_m and not ppm2_m:
        raise LookupError(f"{registry.root}: no model is registered")
    has_s = F.col("surface_m2").isNotNull() & (F.col("surface_m2") != 0)
    routes = [(has_s, price_m or ppm2_m, "price" if price_m else "price_per_m2"),
              (~has_s, ppm2_m or price_m, "price_per_m2" if ppm2_m else "price")]
    out = None
    for cond, (path, is_log), tgt in routes:
        part = predict(PipelineModel.load(path), requests.where(cond), is_log)
        part = part.withColumn("target", F.lit(tgt)).withColumn("used_model", F.lit(path.rsplit("/", 1)[-1].split("_", 1)[0]))
        part = part.withColumn("derived_price", F.when((F.lit(tgt) == "price_per_m2") & has_s,
                                                       F.col("prediction") * F.col("surface_m2")))
        out = part if out is None else out.unionByName(part)
    return out
