"""Queries for model fits, explanation, matrix / model persistence and scoring.

Fitted models are checked by row counts and invariants (tests), not by SQL; explanation and scoring also run on given trees
and weights, which SQL can follow. A model's size is an argument: M1-M6 and H2 fit the reference's sizes (FULL: 300 trees of depth 6;
TUNED: 500; IMPORTANCE: 200, also for the matrix that they train on). The other queries fit CATALOG sizes (10 trees of depth 4), and the
search draws from SMALL_SPACE, four times. Rows are never cut.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from riskflow.operators import encode as E
from riskflow.operators import evaluate as V
from riskflow.operators import explain as K
from riskflow.operators import models as M
from riskflow.operators import score as SC
from riskflow.operators import select as S
from riskflow.operators import split as SP
from riskflow.operators import trees as TR
from riskflow.plans import oracle as O
from riskflow.plans import queries_encode, queries_eval  # noqa: F401  (their tables in SQL)
from riskflow.plans.catalog import query
from riskflow.plans.pipeline import merged, stages, train_report
from riskflow.plans.queries_base import _RISK, _scratch
from riskflow.plans.queries_encode import _MANUAL_SQL
from riskflow.session import cut_lineage
from riskflow.settings import DEFAULT
from riskflow.sources import fixtures as fx
from riskflow.sources import tables as T
from riskflow.streaming.score_stream import RECORD_SCHEMA, score_stream

w = O.with_ctes
FULL, TUNED, IMPORTANCE = DEFAULT, DEFAULT.with_(gbt_trees=500), DEFAULT.with_(gbt_trees=200)
CATALOG = DEFAULT.with_(gbt_trees=10, gbt_depth=4)
SMALL_SPACE = [(name, kind, *{"n_estimators": (5, 15), "max_depth": (2, 5)}.get(name, (lo, hi)))
               for name, kind, lo, hi in M.SEARCH_SPACE]
_MEMO: dict = {}


def _key(spark, sf, what):
    return (spark.sparkContext.applicationId, sf, what)


def matrix(spark, sf, s=CATALOG) -> M.Matrix:
    """The matrix with the features that an importance fit of the sizes in ``s`` chooses."""
    k = _key(spark, sf, ("matrix", s))
    if k not in _MEMO:
        mx = M.model_matrix(stages(spark, sf).crossed, s, importance_select=True)
        _MEMO[k] = M.Matrix(cut_lineage(mx.train), cut_lineage(mx.valid), mx.names)
    return _MEMO[k]


def _gbt(spark, sf):
    """The baseline fit of CATALOG sizes, shared by the queries that use it."""
    k = _key(spark, sf, "gbt")
    if k not in _MEMO:
        _MEMO[k] = M.gbt_baseline(matrix(spark, sf), CATALOG)
    return _MEMO[k]


def _metrics(res):
    return res[2]


@query("logistic_baseline")
def logistic_baseline(spark, sf):
    """M1: L2 logistic regression with balanced weights; validation metrics."""
    return _metrics(M.logistic_baseline(matrix(spark, sf, IMPORTANCE), FULL))


@query("gbt_baseline")
def gbt_baseline(spark, sf):
    """M2: boosted trees with balanced weights; validation metrics."""
    return _metrics(M.gbt_baseline(matrix(spark, sf, IMPORTANCE), FULL))


@query("rf_baseline")
def rf_baseline(spark, sf):
    """Random forest (listed among the reference's planned features); validation metrics."""
    return _metrics(M.rf_baseline(matrix(spark, sf), CATALOG))


@query("gbt_tuned")
def gbt_tuned(spark, sf):
    """M3: 2 x 2 grid, best validation AUC; metrics with the winning parameters."""
    return _metrics(M.gbt_tuned(matrix(spark, sf, IMPORTANCE), TUNED))


@query("kfold_cv")
def kfold_cv(spark, sf):
    """M4: five stratified folds: AUC, n_train, n_val per fold and their mean."""
    mx = matrix(spark, sf, IMPORTANCE)
    return M.kfold_cv(stages(spark, sf).crossed, mx.names, FULL)


@query("xgb_baseline")
def xgb_baseline(spark, sf):
    """M5: depth-6 boosted trees weighted by neg/pos; validation metrics."""
    return _metrics(M.xgb_baseline(matrix(spark, sf, IMPORTANCE), FULL))


@query("cat_baseline")
def cat_baseline(spark, sf):
    """M6: depth-6 boosted trees, class weights {1, neg/pos}, all rows and columns; validation metrics."""
    return _metrics(M.cat_baseline(matrix(spark, sf, IMPORTANCE), FULL))


@query("random_search")
def random_search(spark, sf):
    """M7: random search draws (seeded numpy generator), each fit scored with metrics, cost and confusion."""
    log, _, _ = M.random_search(matrix(spark, sf), CATALOG, n_iter=4, space=SMALL_SPACE)
    return log


@query("model_importance")
def model_importance(spark, sf):
    """H2: gain importance and split counts per feature from boosted trees fitted on the training rows."""
    _, imp = M.model_importance(matrix(spark, sf, IMPORTANCE), _scratch(spark, "gbt-imp"), IMPORTANCE)
    return imp


def _manual(spark, sf):
    k = _key(spark, sf, "manual")
    if k not in _MEMO:
        m = merged(spark, sf)
        feats = E.manual_features_fit(m)
        x = SC.assemble_manual(feats.transform(m, keep=["TransactionID", "isFraud"]))
        split = SP.stratified_split(m.select("TransactionID", "isFraud"))
        x = cut_lineage(x.join(split.select("TransactionID", "is_valid"), "TransactionID"))
        mx = M.Matrix(x.where(~F.col("is_valid")), x.where("is_valid"), list(E.MANUAL_FEATURES))
        clf, sc, met = M.fit_eval(M.gbt(CATALOG), mx, "manual_app", CATALOG)
        _MEMO[k] = (feats, clf, sc, met, m)
    return _MEMO[k]


@query("manual_model")
def manual_model(spark, sf):
    """M9: the app's nine features + boosted trees: validation metrics and confusion counts."""
    _, _, sc, met, _ = _manual(spark, sf)
    return met.join(V.confusion(sc), "model")


@query("shapley_values")
def shapley_values(spark, sf):
    """K1: exact Shapley values of the boosted model's log-odds for every validation row, against a background of
    ``shap_background`` training rows."""
    mx = matrix(spark, sf)
    bg = SP.subsample_n(mx.train, DEFAULT.shap_background, s=CATALOG)
    path = _scratch(spark, "shap-model")
    T.model_save(_gbt(spark, sf)[0], path)
    return K.shapley_values(TR.model_nodes(spark, path), mx.valid, bg, mx.names)


FIXED_FEATURES = ["TransactionAmt", "card1", "addr1", "second"]
#: (tree, node, left, right, feature, threshold, value): two small trees, one with a feature twice on a path.
FIXED_TREES = [
    (0, 0, 1, 2, 0, 50.0, 0.0), (0, 1, 3, 4, 2, 30.0, 0.0), (0, 2, 5, 6, 0, 120.0, 0.0), (0, 3, -1, -1, None, None, 0.1031337),
    (0, 4, -1, -1, None, None, -0.3127191), (0, 5, 7, 8, 1, 70.0, 0.0), (0, 6, -1, -1, None, None, 0.7919373),
    (0, 7, -1, -1, None, None, 0.2573129), (0, 8, -1, -1, None, None, -0.1139711),
    (1, 0, 1, 2, 1, 30.0, 0.0), (1, 1, 3, 4, 3, 40000.0, 0.0), (1, 2, 5, 6, 2, 60.0, 0.0), (1, 3, -1, -1, None, None, 0.1997393),
    (1, 4, -1, -1, None, None, -0.2083717), (1, 5, -1, -1, None, None, -0.0571333), (1, 6, -1, -1, None, None, 0.4219771)]

# the same by enumeration of all 16 coalitions, on the intervals between thresholds
_FIXED_SQL = w("""
WITH x AS (
  SELECT t.TransactionID, t.TransactionID IN (SELECT TransactionID FROM valid_ids) AS valid, TransactionAmt AS x0,
         CAST(card1 AS DOUBLE) AS x1, coalesce(addr1, 0.0) AS x2, CAST(TransactionDT % 86400 AS DOUBLE) AS x3 FROM tx t),
c AS (SELECT *, CASE WHEN x0 <= 50 THEN 0 WHEN x0 <= 120 THEN 1 ELSE 2 END AS c0, CASE WHEN x1 <= 30 THEN 0 WHEN x1 <= 70 THEN 1 ELSE 2 END AS c1,
        CASE WHEN x2 <= 30 THEN 0 WHEN x2 <= 60 THEN 1 ELSE 2 END AS c2, CASE WHEN x3 <= 40000 THEN 0 ELSE 1 END AS c3 FROM x),
bg AS (SELECT c0, c1, c2, c3, count(*) AS n FROM c WHERE NOT valid GROUP BY ALL),
r AS (SELECT DISTINCT c0, c1, c2, c3 FROM c WHERE valid),
h AS (SELECT r.c0, r.c1, r.c2, r.c3, s, n, CASE WHEN s & 1 > 0 THEN r.c0 ELSE bg.c0 END AS h0, CASE WHEN s & 2 > 0 THEN r.c1 ELSE bg.c1 END AS h1,
        CASE WHEN s & 4 > 0 THEN r.c2 ELSE bg.c2 END AS h2, CASE WHEN s & 8 > 0 THEN r.c3 ELSE bg.c3 END AS h3
      FROM r, bg, (SELECT unnest(range(16)) AS s)),
v AS (SELECT c0, c1, c2, c3, s, sum(n * (
        CASE WHEN h0 = 0 THEN CASE WHEN h2 = 0 THEN 0.1031337 ELSE -0.3127191 END WHEN h0 = 1 THEN CASE WHEN h1 <= 1 THEN 0.2573129 ELSE -0.1139711 END ELSE 0.7919373 END
        + CASE WHEN h1 = 0 THEN CASE WHEN h3 = 0 THEN 0.1997393 ELSE -0.2083717 END ELSE CASE WHEN h2 <= 1 THEN -0.0571333 ELSE 0.4219771 END END
      )::DOUBLE) / sum(n) AS v FROM h GROUP BY ALL),
p AS (SELECT a.c0, a.c1, a.c2, a.c3, j, sum((b.v - a.v) * [6.0, 2.0, 2.0, 6.0][bit_count(a.s::BIGINT) + 1] / 24) AS phi
      FROM v a JOIN v b ON a.c0 = b.c0 AND a.c1 = b.c1 AND a.c2 = b.c2 AND a.c3 = b.c3,
           (SELECT unnest(range(4)) AS j) WHERE a.s & (1 << j) = 0 AND b.s = a.s | (1 << j) GROUP BY ALL)
SELECT c.TransactionID, ['TransactionAmt', 'card1', 'addr1', 'second'][j + 1] AS feature, [x0, x1, x2, x3][j + 1] AS value,
       CAST(phi AS DOUBLE) AS phi
FROM c JOIN p ON c.c0 = p.c0 AND c.c1 = p.c1 AND c.c2 = p.c2 AND c.c3 = p.c3 WHERE valid""", "tx", "valid_ids")


@query("shapley_fixed_trees", _FIXED_SQL)
def shapley_fixed_trees(spark, sf):
    """K1 on a given node table: every validation row against all training rows."""
    t = fx.tx(spark, sf).withColumn("second", F.col("TransactionDT") % 86400).na.fill(0.0, subset=["addr1"])
    x = S.assemble(t, FIXED_FEATURES).join(SP.stratified_split(t.select("TransactionID", "isFraud")).select("TransactionID", "is_valid"),
                                           "TransactionID")
    nodes = spark.createDataFrame(FIXED_TREES, TR.NODES)
    return K.shapley_values(nodes, x.where("is_valid"), x.where("not is_valid"), FIXED_FEATURES)


@query("sink_matrix")
def sink_matrix(spark, sf):
    """A5: the assembled validation matrix written to Parquet (names in metadata and a names table), read back."""
    mx = matrix(spark, sf)
    return T.sink_matrix(mx.valid, _scratch(spark, "matrix"))


@query("model_save_load")
def model_save_load(spark, sf):
    """A fitted model saved, loaded back and used to score the validation rows."""
    mx = matrix(spark, sf)
    model, _, _ = _gbt(spark, sf)
    path = _scratch(spark, "model")
    T.model_save(model, path)
    return M.score_table(T.model_load(path), mx.valid, "reloaded", CATALOG)


@query("score_lookup")
def score_lookup(spark, sf):
    """L1: validation rows with business fields, fraud probability and label."""
    mx = matrix(spark, sf)
    model, _, _ = _gbt(spark, sf)
    return SC.score_lookup(model, mx.valid, stages(spark, sf, until="behavior").behavior)


@query("score_batch")
def score_batch(spark, sf):
    """L2: six-field records scored by the app's model: probability, label at 0.5, risk band."""
    feats, clf, _, _, m = _manual(spark, sf)
    return SC.score_batch(feats, clf, m.select(*[f.name for f in RECORD_SCHEMA.fields]))


@query("score_stream")
def score_stream_q(spark, sf):
    """L3: the same records arriving as files, scored by a Structured Streaming job (availableNow trigger)."""
    feats, clf, _, _, m = _manual(spark, sf)
    src = _scratch(spark, "stream-src")
    m.select(*[F.col(f.name).cast(f.dataType) for f in RECORD_SCHEMA.fields]).write.mode("overwrite").parquet(src)
    base = _scratch(spark, "stream")
    return score_stream(spark, src, os.path.join(base, "sink"), os.path.join(base, "ckpt"), feats, clf)


# ---- scoring with given weights: what L1-L3 and A6 do around a model, in SQL ----------------------------------------------

LINEAR_FEATURES = ["TransactionAmt", "DT_hour", "card1_txn_cnt", "card1_amt_mean"]
LINEAR = SC.LinearModel([0.02, -0.03, -0.01, 0.004], -0.5)
MANUAL_LINEAR = SC.LinearModel([0.01, -0.2, 0.001, -0.004, 0.003, 0.15, 0.1, -0.07, 0.05], -0.25)


def _sigmoid(model: SC.LinearModel, cols: list[str]) -> str:
    z = " + ".join([repr(model.bias), *[f"{v!r} * CAST({c} AS DOUBLE)" for v, c in zip(model.weights, cols)]])
    return f"1.0 / (1.0 + exp(-CAST({z} AS DOUBLE)))"


def _linear_rows(spark, sf):
    b = stages(spark, sf, until="behavior").behavior
    return S.assemble(b, LINEAR_FEATURES).join(SP.split_index(fx.tx(spark, sf)), "TransactionID"), b


@query("score_lookup_linear", w(f"""
SELECT TransactionID, p, CAST(p >= 0.5 AS INTEGER) AS label, TransactionAmt, DT_week, DT_day, DT_hour, card1, addr1, DeviceType_norm,
       DeviceInfo_brand, P_emaildomain_provider, isFraud
FROM (SELECT b.*, {_sigmoid(LINEAR, LINEAR_FEATURES)} AS p FROM behavior b JOIN valid_ids v ON v.TransactionID = b.TransactionID) t""",
                                "behavior", "valid_ids"))
def score_lookup_linear(spark, sf):
    """L1 with given weights: the validation rows' business fields, probability and label."""
    x, b = _linear_rows(spark, sf)
    return SC.score_lookup(LINEAR, x, b)


@query("linear_save_load", w(f"""
SELECT b.TransactionID, 'linear' AS model, CAST(isFraud AS INTEGER) AS y, {_sigmoid(LINEAR, LINEAR_FEATURES)} AS p
FROM behavior b JOIN valid_ids v ON v.TransactionID = b.TransactionID""", "behavior", "valid_ids"))
def linear_save_load(spark, sf):
    """Weights stored as a state, loaded back, and the validation rows' score table."""
    path = _scratch(spark, "linear")
    LINEAR.save(spark, path)
    return M.score_table(SC.LinearModel.load(spark, path), _linear_rows(spark, sf)[0], "linear", CATALOG)


_BATCH_SQL = (f"SELECT TransactionID, p, CAST(p >= 0.5 AS INTEGER) AS label, {_RISK} AS risk_level FROM (SELECT TransactionID, "
              f"{_sigmoid(MANUAL_LINEAR, E.MANUAL_FEATURES)} AS p FROM ({_MANUAL_SQL}) m) t")


@query("score_batch_linear", _BATCH_SQL)
def score_batch_linear(spark, sf):
    """L2 with given weights: six-field records, the app's nine features, probability, label, risk band."""
    m = merged(spark, sf)
    return SC.score_batch(E.manual_features_fit(m), MANUAL_LINEAR, m.select(*[f.name for f in RECORD_SCHEMA.fields]))


@query("score_stream_linear", _BATCH_SQL)
def score_stream_linear(spark, sf):
    """L3 with given weights: the same records arriving as files, scored by a Structured Streaming job."""
    m = merged(spark, sf)
    src, base = _scratch(spark, "stream-src"), _scratch(spark, "stream")
    m.select(*[F.col(f.name).cast(f.dataType) for f in RECORD_SCHEMA.fields]).write.mode("overwrite").parquet(src)
    return score_stream(spark, src, os.path.join(base, "sink"), os.path.join(base, "ckpt"), E.manual_features_fit(m), MANUAL_LINEAR)


@query("kfold_sizes", w("""
WITH f AS (SELECT CAST((rk - 1) % 5 + 1 AS INTEGER) AS fold FROM ranked),
k AS (SELECT unnest(range(1, 6)) AS fold)
SELECT CAST(k.fold AS VARCHAR) AS fold, CAST((SELECT count(*) FROM f) - count(f.fold) AS DOUBLE) AS n_train, CAST(count(f.fold) AS DOUBLE) AS n_val
FROM k LEFT JOIN f ON f.fold = k.fold GROUP BY k.fold""", "ranked"))
def kfold_sizes(spark, sf):
    """M4's training and validation rows of each fold."""
    return M.fold_sizes(SP.stratified_kfold(fx.tx(spark, sf).select("TransactionID", "isFraud")))


# ---- one run on fitted models: train -> ensemble -> metric files -> segments ------------------------------------------------


def _trained(spark, sf):
    k = _key(spark, sf, "report")
    if k not in _MEMO:
        _MEMO[k] = train_report(matrix(spark, sf), stages(spark, sf, until="behavior").behavior, CATALOG)
    return _MEMO[k]


@query("trained_metrics", None)
def trained_metrics(spark, sf):
    """M1-M6 fitted, averaged (M10), and the stacked metric tables (J10) of their validation scores."""
    return _trained(spark, sf)["metrics"]


@query("trained_segments", None)
def trained_segments(spark, sf):
    """J13-J16 of the fitted models' average on the validation rows."""
    return _trained(spark, sf)["segments"]


@query("prefix_sizes", None)
def prefix_sizes(spark, sf):
    """M2 at every size up to the fitted one, from the one fit: metrics and cost of its first 1, 2, ... trees."""
    return M.prefix_metrics(_gbt(spark, sf)[0], matrix(spark, sf), list(range(1, CATALOG.gbt_trees + 1)), CATALOG)
