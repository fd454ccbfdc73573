"""Models (M1-M9, H2, rf): distributed training with Spark ML estimators on the assembled matrix.

The reference's boosters (LightGBM, XGBoost, CatBoost) are re-aimed at Spark ML's
``GBTClassifier`` / ``RandomForestClassifier`` / ``LogisticRegression``; their sizes
come from ``Settings`` (reference defaults), class weights from I5 / I6. Every fit
returns a *score table* ``(TransactionID, model, y, p)`` on the validation rows, and
all metrics are aggregates of it (``evaluate``). Loops over parameter grids, folds
and search draws run on the driver; each fit is a distributed Spark job.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators import evaluate as V
from riskflow.operators import select as S
from riskflow.operators import split as SP
from riskflow.operators.trees import model_nodes, prefix_margins
from riskflow.session import cut_lineage, scratch_dir
from riskflow.settings import DEFAULT, Settings


@dataclass
class Matrix:
    train: DataFrame
    valid: DataFrame
    names: list[str]


def model_matrix(df: DataFrame, s: Settings = DEFAULT, exclude: list[str] = (),
                 importance_select: bool = False) -> Matrix:
    """Variance-filtered numeric features (H1, NULL -> 0) assembled into a vector, split 80/20 by I1.

    With ``importance_select`` the next step runs too: boosted trees fitted on the training rows rank the features
    by split counts (H2) and only those with a split, at most ``top_n_features``, are kept (H3).
    """
    filtered, kept = S.variance_filter(df, s.variance_threshold, s.target, s)
    kept = [c for c in kept if c not in exclude]
    base = filtered.select(*dict.fromkeys([s.id_col, s.target, *kept])).na.fill(0.0, subset=kept)
    split = SP.stratified_split(base.select(s.id_col, s.target), s.target, s.id_col, s.valid_size, s.seed, s)
    flags = split.select(s.id_col, "is_valid")
    m = S.assemble(base, kept, s.target, s.id_col).join(flags, s.id_col, "inner")
    if importance_select:
        m = cut_lineage(m, "matrix")  # the fit's passes and the chosen columns read it
    mx = Matrix(m.where(~F.col("is_valid")).drop("is_valid"), m.where("is_valid").drop("is_valid"), kept)
    if not importance_select:
        return mx
    _, imp = model_importance(mx, os.path.join(scratch_dir(df.sparkSession), f"importance-{uuid.uuid4().hex}"), s)
    imp = imp.select("feature", F.col("splits").cast("double").alias("importance"))
    chosen = [r["feature"] for r in S.select_top_features(imp, s.top_n_features).collect()]  # <= column count
    chosen = [c for c in kept if c in set(chosen)]
    m = _chosen(m, kept, chosen)
    return Matrix(m.where(~F.col("is_valid")).drop("is_valid"), m.where("is_valid").drop("is_valid"), chosen)


def _chosen(m: DataFrame, names: list[str], chosen: list[str]) -> DataFrame:
    """``m`` with only the ``chosen`` of its vector's features, in the order of ``names``."""
    at = [i for i, c in enumerate(names) if c in set(chosen)]
    d = VectorSlicer(inputCol="features", outputCol="_chosen", indices=at).transform(m)
    return d.drop("features").withColumnRenamed("_chosen", "features").select(*m.columns)


def _weighted(train: DataFrame, s: Settings, mode: str = "balanced") -> DataFrame:
    if mode == "balanced":
        return SP.balanced_weight(train, s.target)
    if mode == "scale_pos":
        out, _ = SP.scale_pos_weight(train, s.target)
        return out
    return train.withColumn("weight", F.lit(1.0))


def score_table(model, df: DataFrame, name: str, s: Settings = DEFAULT) -> DataFrame:
    """(TransactionID, model, y, p) with p = P(fraud)."""
    out = model.transform(df)
    return out.select(s.id_col, F.lit(name).alias("model"), F.col(s.target).cast("int").alias("y"),
                      vector_to_array("probability")[1].alias("p"))


def gbt(s: Settings = DEFAULT, seed: int | None = None, **kw) -> GBTClassifier:
    params = dict(maxIter=s.gbt_trees, stepSize=s.gbt_step, maxDepth=s.gbt_depth, subsamplingRate=s.gbt_subsample,
                  featureSubsetStrategy=s.gbt_feature_share, seed=s.seed if seed is None else seed)
    params.update(kw)
    return GBTClassifier(featuresCol="features", labelCol=s.target, weightCol="weight", **params)


def fit_eval(est, mx: Matrix, name: str, s: Settings = DEFAULT, weights: str = "balanced",
             train: DataFrame | None = None):
    """Fit on the (weighted) training rows, score the validation rows; returns (model, scores, metrics).

    The score table is stored, so each row is scored once however many metrics read it."""
    tr = _weighted(mx.train if train is None else train, s, weights)
    model = est.fit(tr)
    sc = cut_lineage(score_table(model, mx.valid, name, s), "scores")
    return model, sc, V.binary_metrics(sc, ["model"], s=s)


def logistic_baseline(mx: Matrix, s: Settings = DEFAULT):
    """M1: L2 logistic regression (L-BFGS, 200 iterations, balanced weights) on all training rows."""
    n = max(mx.train.count(), 1)
    est = LogisticRegression(featuresCol="features", labelCol=s.target, weightCol="weight", maxIter=200,
                             regParam=1.0 / n, elasticNetParam=0.0, standardization=False)
    return fit_eval(est, mx, "LogisticRegression_baseline", s)


def gbt_baseline(mx: Matrix, s: Settings = DEFAULT):
    """M2: boosted trees, lr 0.05, row / column share 0.8, balanced weights."""
    return fit_eval(gbt(s), mx, "GBT_baseline", s)


def rf_baseline(mx: Matrix, s: Settings = DEFAULT):
    """Random forest listed among the reference's planned features, balanced weights."""
    est = RandomForestClassifier(featuresCol="features", labelCol=s.target, weightCol="weight", numTrees=s.gbt_trees,
                                 maxDepth=s.gbt_depth, seed=s.seed)
    return fit_eval(est, mx, "RandomForest_baseline", s)


def xgb_baseline(mx: Matrix, s: Settings = DEFAULT):
    """M5: depth-6 boosted trees, positives weighted by neg / pos (scale_pos_weight)."""
    return fit_eval(gbt(s, maxDepth=6), mx, "XGB_baseline", s, weights="scale_pos")


def cat_baseline(mx: Matrix, s: Settings = DEFAULT):
    """M6: depth-6 boosted trees on all rows and columns, class weights {1, neg/pos}, the common seed."""
    return fit_eval(gbt(s, maxDepth=6, subsamplingRate=1.0, featureSubsetStrategy="all"), mx, "CAT_baseline", s,
                    weights="scale_pos")


# Fixed values (reference): the tuning grid - 2 leaf sizes x 2 minimum child sizes (one row / column share).
TUNE_DEPTHS = [5, 6]          # ~32 and ~64 leaves
TUNE_MIN_CHILD = [20, 60]


def together(jobs: list, parallel: int) -> list:
    """The results of the calls ``jobs``, in order, at most ``parallel`` at a time. A fit is many small Spark jobs with the driver's
    work between them; fits submitted at once fill each other's gaps."""
    if parallel <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    inherit = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPool(min(parallel, len(jobs))) as pool:
        return pool.map(lambda run: run(), [inherit(job) for job in jobs])


def prefix_metrics(model, mx: Matrix, sizes: list[int], s: Settings = DEFAULT) -> DataFrame:
    """Metrics and cost on the validation rows of the first ``size`` trees of one boosted fit, for all ``sizes``.

    A boosted model of n trees begins with the model of any smaller size (same draws, same seed), so sizes need no fits of
    their own: the fit's node table scores all prefixes in one pass (``trees.prefix_margins``)."""
    spark = mx.valid.sparkSession
    path = os.path.join(scratch_dir(spark), f"prefix-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    d = prefix_margins(model_nodes(spark, path), mx.valid, sizes, [s.target], id_col=s.id_col)
    sc = cut_lineage(d.select(s.id_col, F.concat(F.lit("trees_"), F.col("size").cast("string")).alias("model"),
                              F.col(s.target).cast("int").alias("y"), (1 / (1 + F.exp(-F.col("margin")))).alias("p")), "prefixes")
    out = V.binary_metrics(sc, ["model"], s=s).join(V.business_cost(sc, ["model"], s=s), "model")
    return out.withColumn("size", F.substring_index("model", "_", -1).cast("int"))


def best_size(prefixes: DataFrame) -> int:
    """The early stop: the least cost, ties to the higher AUC, then to the smaller size."""
    return prefixes.orderBy("cost", F.desc_nulls_last("auc"), "size").first()["size"]


def gbt_tuned(mx: Matrix, s: Settings = DEFAULT):
    """M3: 2 x 2 grid (``ParamGridBuilder``) fitted on the fixed I1 split, best validation AUC, the first on ties.
    (``TrainValidationSplit`` would draw its own random split, so the grid is walked here.)"""
    est = gbt(s)
    grid = ParamGridBuilder().addGrid(est.maxDepth, TUNE_DEPTHS).addGrid(est.minInstancesPerNode, TUNE_MIN_CHILD).build()
    best = None
    fits = together([partial(fit_eval, est.copy(params), mx, "GBT_tuned", s) for params in grid], s.parallel_fits)
    for params, (model, sc, met) in zip(grid, fits):
        auc = met.first()["auc"]
        if best is None or (auc is not None and auc > best[0]):
            text = ", ".join(f"{p.name}={v}" for p, v in params.items())
            best = (auc, model, sc, met.withColumn("params", F.lit(text)))
    return best[1], best[2], best[3]


def fold_sizes(folds: DataFrame, n_folds: int = DEFAULT.n_folds) -> DataFrame:
    """M4's (fold, n_train, n_val), an empty fold included."""
    every = folds.sparkSession.range(1, n_folds + 1).select(F.col("id").cast("int").alias("fold"))
    own = every.join(folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n_val")), "fold", "left").select(
        "fold", F.coalesce("n_val", F.lit(0)).alias("n_val"))
    total = own.agg(F.sum("n_val")).first()[0]  # one row per fold
    return own.select(F.col("fold").cast("string").alias("fold"), (F.lit(total) - F.col("n_val")).cast("double").alias("n_train"),
                      F.col("n_val").cast("double").alias("n_val"))


def kfold_cv(df: DataFrame, names: list[str], s: Settings = DEFAULT) -> DataFrame:
    """M4: per fold AUC, n_train, n_val on the I3 folds, plus a 'mean' row."""
    base = df.select(*dict.fromkeys([s.id_col, s.target, *names])).na.fill(0.0, subset=names)
    mx_all = S.assemble(base, names, s.target, s.id_col)
    folds = SP.stratified_kfold(df.select(s.id_col, s.target), s.n_folds, s.target, s.id_col, s.seed, s)
    data = cut_lineage(mx_all.join(folds.select(s.id_col, "fold"), s.id_col, "inner"), "folds")
    sizes = {int(r["fold"]): r for r in fold_sizes(data, s.n_folds).collect()}  # one row per fold
    rows = []

    def one(k: int):
        tr, va = data.where(F.col("fold") != k), data.where(F.col("fold") == k)
        model = gbt(s, seed=s.seed + k).fit(_weighted(tr, s))
        sc = cut_lineage(score_table(model, va, f"fold{k}", s), "scores")
        got = V.roc_auc(sc, ["model"], s=s).first()  # none for a fold without rows
        return got["auc"] if got else None

    aucs = together([partial(one, k) for k in range(1, s.n_folds + 1)], s.parallel_fits)
    for k, auc in enumerate(aucs, 1):
        rows.append((str(k), float(auc) if auc is not None else None, sizes[k]["n_train"], sizes[k]["n_val"]))
    aucs = [r[1] for r in rows if r[1] is not None]
    rows.append(("mean", float(np.mean(aucs)) if aucs else None, float(np.mean([r[2] for r in rows])),
                 float(np.mean([r[3] for r in rows]))))
    return df.sparkSession.createDataFrame(rows, "fold string, auc double, n_train double, n_val double")


# Fixed values (reference): parameter, kind and half-open range of the random search, in the order of the draws.
SEARCH_SPACE = [
    ("num_leaves", "int", 32, 128), ("min_child_samples", "int", 20, 200), ("max_depth", "int", 4, 12),
    ("subsample", "float", 0.6, 1.0), ("colsample_bytree", "float", 0.6, 1.0), ("reg_alpha", "float", 0.0, 1.0),
    ("reg_lambda", "float", 0.0, 1.0), ("min_split_gain", "float", 0.0, 0.5), ("n_estimators", "int", 200, 600),
]
#: What Spark's trees have no counterpart for; logged as drawn, not fitted.
UNMAPPED = ("num_leaves", "reg_alpha", "reg_lambda")


def draws(seed: int, n: int, space: list[tuple] = SEARCH_SPACE) -> list[dict]:
    """``n`` draws from a space of (parameter, kind, low, high), by one numpy generator."""
    rng = np.random.default_rng(seed)
    pick = {"int": lambda lo, hi: int(rng.integers(lo, hi)), "float": lambda lo, hi: float(rng.uniform(lo, hi))}
    return [{name: pick[kind](lo, hi) for name, kind, lo, hi in space} for _ in range(n)]


def search_estimator(p: dict, weight_sum: float, s: Settings = DEFAULT) -> tuple[GBTClassifier, dict]:
    """The estimator of a draw and the parameters it really gets.

    The drawn gain is a sum over rows, Spark's ``minInfoGain`` a mean per weighted row, so it is divided by their sum.
    """
    fitted = dict(maxIter=p["n_estimators"], maxDepth=p["max_depth"], minInstancesPerNode=p["min_child_samples"],
                  subsamplingRate=p["subsample"], featureSubsetStrategy=str(round(p["colsample_bytree"], 4)),
                  minInfoGain=p["min_split_gain"] / max(weight_sum, 1.0))
    return gbt(s, **fitted), fitted


def random_search(mx: Matrix, s: Settings = DEFAULT, n_iter: int = 20, space: list[tuple] = SEARCH_SPACE):
    """M7: ``n_iter`` draws from ``space`` (numpy generator seeded 42 + 123), each a GBT fit scored on the validation
    rows; returns (log, best model, best row). ``params`` in the log are the parameters of the fit and, under
    ``unmapped``, those drawn for which Spark's trees have no counterpart."""
    weight_sum = float(_weighted(mx.train, s).agg(F.sum("weight")).first()[0] or 0.0)
    logs, models = [], {}
    drawn = [(i, p, *search_estimator(p, weight_sum, s)) for i, p in enumerate(draws(s.seed + 123, n_iter, space), 1)]
    fits = together([partial(fit_eval, est, mx, f"draw{i}", s) for i, _, est, _ in drawn], s.parallel_fits)
    for (i, p, _, fitted), (model, sc, met) in zip(drawn, fits):
        cost = V.business_cost(sc, ["model"], s=s)
        text = str({**fitted, "unmapped": {k: p[k] for k in UNMAPPED if k in p}})
        logs.append(met.join(cost, "model").withColumn("iter", F.lit(i)).withColumn("params", F.lit(text)))
        models[i] = model
    log = logs[0]
    for r in logs[1:]:
        log = log.unionByName(r)
    log = cut_lineage(log, "search")
    best = V.search_argbest(log)
    return log, models[best.first()["iter"]], best


def model_importance(mx: Matrix, path: str, s: Settings = DEFAULT):
    """H2: boosted trees on the training rows; (feature, importance = gain share, splits = split count).

    Split counts (LightGBM's default importance) are read from the saved model's node table:
    internal nodes (leftChild >= 0) grouped by their split feature.
    """
    model = gbt(s).fit(_weighted(mx.train, s))
    model.write().overwrite().save(path)
    spark = mx.train.sparkSession
    nodes = spark.read.parquet(path + "/data")
    splits = (nodes.where(F.col("nodeData.leftChild") >= 0)
              .groupBy(F.col("nodeData.split.featureIndex").alias("idx")).agg(F.count(F.lit(1)).alias("splits")))
    gains = spark.createDataFrame([(i, n, float(v)) for i, (n, v) in
                                   enumerate(zip(mx.names, model.featureImportances.toArray().tolist()))],
                                  "idx int, feature string, importance double")
    imp = gains.join(splits, "idx", "left").select(
        "feature", "importance", F.coalesce(F.col("splits"), F.lit(0)).cast("int").alias("splits"))
    return model, imp
