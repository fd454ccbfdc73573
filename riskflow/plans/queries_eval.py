"""Queries for metrics, curves, thresholds, segments, metric files and contribution tables
(J1-J16, C4, M8, M10, H3, H4, K2-K4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskflow.operators import evaluate as V
from riskflow.operators import explain as K
from riskflow.operators import select as S
from riskflow.operators import split as SP
from riskflow.plans import oracle as O
from riskflow.plans.catalog import query
from riskflow.plans.pipeline import stages
from riskflow.session import cut_lineage
from riskflow.settings import DEFAULT
from riskflow.sources import fixtures as fx

w = O.with_ctes
_TS = "CAST([" + ", ".join(repr(t) for t in V.thresholds()) + "] AS DOUBLE[])"


def metrics_sql(src: str, by: list[str]) -> str:
    """n, auc, accuracy, precision, recall, f1 per ``by`` over a relation with (by..., y, p)."""
    b = ", ".join(by)
    on = " AND ".join(f"c.{k} IS NOT DISTINCT FROM a.{k}" for k in by)
    return f"""
(SELECT {", ".join('c.' + k for k in by)}, CAST(c.tp + c.tn + c.fp + c.fn AS BIGINT) AS n, a.auc,
        coalesce(CAST(c.tp + c.tn AS DOUBLE) / nullif(c.tp + c.tn + c.fp + c.fn, 0), 0.0) AS accuracy,
        coalesce(CAST(c.tp AS DOUBLE) / nullif(c.tp + c.fp, 0), 0.0) AS precision,
        coalesce(CAST(c.tp AS DOUBLE) / nullif(c.tp + c.fn, 0), 0.0) AS recall,
        coalesce(CAST(2 * c.tp AS DOUBLE) / nullif(2 * c.tp + c.fp + c.fn, 0), 0.0) AS f1
 FROM (SELECT {b}, sum(CASE WHEN p < 0.5 AND y <> 1 THEN 1 ELSE 0 END) AS tn,
              sum(CASE WHEN p >= 0.5 AND y <> 1 THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN p < 0.5 AND y = 1 THEN 1 ELSE 0 END) AS fn,
              sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS tp FROM {src} GROUP BY {b}) c
 JOIN {auc_sql(src, by)} a ON {on})"""


def points_sql(src: str, by: list[str]) -> str:
    b = ", ".join(by)
    return f"""
(SELECT *, sum(pos) OVER (PARTITION BY {b} ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
           sum(neg) OVER (PARTITION BY {b} ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
           row_number() OVER (PARTITION BY {b} ORDER BY p DESC) AS rk,
           sum(pos) OVER (PARTITION BY {b}) AS tot_pos, sum(neg) OVER (PARTITION BY {b}) AS tot_neg
 FROM (SELECT {b}, p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
       FROM {src} WHERE p IS NOT NULL GROUP BY {b}, p) d)"""


def auc_sql(src: str, by: list[str]) -> str:
    b = ", ".join(by)
    return f"""
(SELECT {b}, CAST(2 * sum(pos) * sum(neg) - 2 * sum(pos * cum_neg) + sum(pos * neg) AS DOUBLE)
             / nullif(CAST(2 * sum(pos) * sum(neg) AS DOUBLE), 0) AS auc
 FROM {points_sql(src, by)} t GROUP BY {b})"""


def _scores(spark, sf):
    return fx.scores(spark, sf)


# ---- J1-J9, C4 ---------------------------------------------------------------------------------


@query("confusion", w("""
SELECT model, CAST(sum(CASE WHEN p < 0.5 AND y <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
       CAST(sum(CASE WHEN p >= 0.5 AND y <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN p < 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
FROM scores GROUP BY model""", "scores"))
def confusion(spark, sf):
    """Tn, fp, fn, tp at p >= 0.5 per model."""
    return V.confusion(_scores(spark, sf))


@query("binary_metrics", w(f"SELECT * FROM {metrics_sql('scores', ['model'])} m", "scores"))
def binary_metrics(spark, sf):
    """Auc, accuracy, precision, recall, f1 (zero denominators -> 0) per model."""
    return V.binary_metrics(_scores(spark, sf))


@query("roc_auc", w(f"SELECT * FROM {auc_sql('scores', ['model'])} a", "scores"))
def roc_auc(spark, sf):
    """Exact AUC per model with ties counted half."""
    return V.roc_auc(_scores(spark, sf))


_TCROSS = f"""
SELECT model, threshold, CAST(sum(CASE WHEN p >= threshold AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
       CAST(sum(CASE WHEN p >= threshold AND y <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN p < threshold AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(sum(CASE WHEN p < threshold AND y <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn
FROM scores, (SELECT unnest({_TS}) AS threshold) t GROUP BY model, threshold"""
O.cte("tcross", ["scores"], _TCROSS)
O.cte("tmetrics", ["tcross"], """
SELECT model, threshold, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
       coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall,
       coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM tcross""")


@query("threshold_cross", w("SELECT * FROM tcross", "tcross"))
def threshold_cross(spark, sf):
    """C4: confusion counts of every score against each of 40 thresholds (bucket + suffix sum, no cross join)."""
    return V.threshold_cross(_scores(spark, sf))


@query("threshold_metrics", w("SELECT * FROM tmetrics", "tmetrics"))
def threshold_metrics(spark, sf):
    """Precision, recall, F1 at 40 thresholds linspace(0.05, 0.95)."""
    return V.threshold_metrics(_scores(spark, sf))


@query("best_threshold", w("""
SELECT model, threshold, precision, recall, f1 FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) AS r FROM tmetrics) t WHERE r = 1""",
                           "tmetrics"))
def best_threshold(spark, sf):
    """The threshold with the best F1 per model (lowest on ties)."""
    return V.best_threshold(V.threshold_metrics(_scores(spark, sf)))


@query("roc_curve", w(f"""
SELECT model, threshold, fpr, tpr FROM (
  SELECT model, p AS threshold, CAST(cum_neg AS DOUBLE) / nullif(tot_neg, 0) AS fpr, CAST(cum_pos AS DOUBLE) / nullif(tot_pos, 0) AS tpr,
         lag(cum_neg) OVER o AS fp0, lead(cum_neg) OVER o AS fp2, lag(cum_pos) OVER o AS tp0, lead(cum_pos) OVER o AS tp2,
         cum_neg, cum_pos
  FROM {points_sql('scores', ['model'])} t WINDOW o AS (PARTITION BY model ORDER BY p DESC)) k
WHERE tp0 IS NULL OR tp2 IS NULL OR fp0 - 2 * cum_neg + fp2 <> 0 OR tp0 - 2 * cum_pos + tp2 <> 0
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM scores""", "scores"))
def roc_curve(spark, sf):
    """ROC points per model with collinear intermediate points dropped, from (0, 0)."""
    return V.roc_curve(_scores(spark, sf))


@query("pr_curve", w(f"""
SELECT model, p AS threshold, coalesce(CAST(cum_pos AS DOUBLE) / nullif(cum_pos + cum_neg, 0), 0.0) AS precision,
       CASE WHEN tot_pos = 0 THEN 1.0 ELSE CAST(cum_pos AS DOUBLE) / tot_pos END AS recall
FROM {points_sql('scores', ['model'])} t
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM scores""", "scores"))
def pr_curve(spark, sf):
    """Precision / recall at every distinct score, ending at (1, 0)."""
    return V.pr_curve(_scores(spark, sf))


@query("average_precision", w(f"""
SELECT model, sum(pos * (CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg))) / nullif(CAST(sum(pos) AS DOUBLE), 0)
       AS average_precision
FROM {points_sql('scores', ['model'])} t GROUP BY model""", "scores"))
def average_precision(spark, sf):
    """Average precision per model."""
    return V.average_precision(_scores(spark, sf))


O.cte("cost", ["scores"], f"""
SELECT model, CAST({DEFAULT.fn_cost} * fn + {DEFAULT.fp_cost} * fp AS DOUBLE) AS cost, tn, fp, fn, tp FROM (
  SELECT model, CAST(sum(CASE WHEN p < 0.5 AND y <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN p >= 0.5 AND y <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN p < 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN p >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM scores GROUP BY model) c""")


@query("business_cost", w("SELECT * FROM cost", "cost"))
def business_cost(spark, sf):
    """5 * FN + 1 * FP per model."""
    return V.business_cost(_scores(spark, sf))


# ---- M8, M10: search log and ensemble ----------------------------------------------------------

O.cte("slog", ["scores", "cost"], f"""
SELECT m.*, c.cost, c.tn, c.fp, c.fn, c.tp, CAST(dense_rank() OVER (ORDER BY m.model) AS INTEGER) AS iter
FROM {metrics_sql('scores', ['model'])} m JOIN cost c ON m.model = c.model""")


@query("search_log", w("SELECT * FROM slog", "slog"))
def search_log(spark, sf):
    """M7's log table: metrics, cost and confusion counts of every candidate model."""
    return V.search_log(_scores(spark, sf))


@query("search_argbest", w("SELECT * FROM slog ORDER BY cost, auc DESC, iter LIMIT 1", "slog"))
def search_argbest(spark, sf):
    """M8: the candidate with the lowest cost, ties to the higher AUC."""
    return V.search_argbest(V.search_log(_scores(spark, sf)))


@query("ensemble_avg", w("SELECT TransactionID, 'Ensemble_avg' AS model, max(y) AS y, avg(p) AS p FROM scores "
                         "GROUP BY TransactionID", "scores"))
def ensemble_avg(spark, sf):
    """Mean probability of the models present (>= 2) per transaction."""
    return V.ensemble_avg(_scores(spark, sf))


# ---- J10, J11: metric files --------------------------------------------------------------------

O.cte("valid_ids", ["ranked"], "SELECT TransactionID FROM ranked WHERE rk <= floor(0.2 * n_class + 0.5)")
O.cte("vscores", ["scores", "valid_ids"], "SELECT s.* FROM scores s JOIN valid_ids v ON s.TransactionID = v.TransactionID")
O.cte("ens", ["scores"], "SELECT TransactionID, 'Ensemble_avg' AS model, max(y) AS y, avg(p) AS p FROM scores "
                         "GROUP BY TransactionID")
O.cte("allm", ["scores", "ens"], "SELECT TransactionID, model, y, p FROM scores UNION ALL SELECT * FROM ens")


def _file_sql(src: str, models: list[str], tag: str, order: int) -> str:
    ms = ", ".join(f"'{m}'" for m in models)
    return (f"SELECT *, CAST(row_number() OVER (ORDER BY model) - 1 AS INTEGER) AS row_order, '{tag}' AS src, "
            f"{order} AS src_order FROM {metrics_sql(src, ['model'])} m WHERE model IN ({ms})")


O.cte("mfiles", ["scores", "vscores", "allm", "slog"], f"""
SELECT model, n, auc, accuracy, precision, recall, f1, row_order, src, src_order,
       CAST(NULL AS INTEGER) AS iter, CAST(NULL AS DOUBLE) AS cost, CAST(NULL AS BIGINT) AS tn, CAST(NULL AS BIGINT) AS fp,
       CAST(NULL AS BIGINT) AS fn, CAST(NULL AS BIGINT) AS tp
FROM ({_file_sql('scores', ['m1', 'm2'], 'baseline', 0)}
      UNION ALL {_file_sql('scores', ['m3'], 'tuned', 1)}
      UNION ALL {_file_sql('allm', ['m1', 'm2', 'm3', 'Ensemble_avg'], 'ensemble', 2)}
      UNION ALL {_file_sql('vscores', ['m2', 'm3'], 'more_models', 3)}) f
UNION ALL
SELECT NULL, n, auc, accuracy, precision, recall, f1, 0, 'cost_sensitive', 4, iter, cost, tn, fp, fn, tp
FROM (SELECT * FROM slog ORDER BY cost, auc DESC, iter LIMIT 1) b""")


def _metric_files(spark, sf):
    sc = _scores(spark, sf)
    valid = SP.split_index(fx.tx(spark, sf))
    vsc = sc.join(valid, "TransactionID", "inner")
    allm = sc.unionByName(V.ensemble_avg(sc))

    def file_(src, models):
        m = V.binary_metrics(src.where(F.col("model").isin(models)))
        # one row per model of the file: a global window over a handful of rows
        return m.withColumn("row_order", F.dense_rank().over(Window.orderBy("model")) - 1)

    best = V.search_argbest(V.search_log(sc)).drop("model").withColumn("row_order", F.lit(0))
    return {
        "baseline": file_(sc, ["m1", "m2"]),
        "tuned": file_(sc, ["m3"]),
        "ensemble": file_(allm, ["m1", "m2", "m3", "Ensemble_avg"]),
        "more_models": file_(vsc, ["m2", "m3"]),
        "cost_sensitive": best,
    }


def _typed(df):
    return df.select(
        "model", "n", "auc", "accuracy", "precision", "recall", "f1", F.col("row_order").cast("int").alias("row_order"),
        "src", F.col("src_order").cast("int").alias("src_order"), F.col("iter").cast("int").alias("iter"),
        F.col("cost").cast("double").alias("cost"), *[F.col(c).cast("bigint").alias(c) for c in ["tn", "fp", "fn", "tp"]])


@query("metrics_union", w("SELECT * FROM mfiles", "mfiles"))
def metrics_union(spark, sf):
    """The five metric tables (from the score table) stacked in source order, missing columns NULL."""
    return _typed(V.metrics_union(_metric_files(spark, sf)))


@query("metrics_latest", w("""
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY src_order DESC, row_order DESC) AS r
                           FROM mfiles) t WHERE r = 1""", "mfiles"))
def metrics_latest(spark, sf):
    """One row per model, last one wins; the model-less cost row is its own key."""
    return _typed(V.metrics_latest(V.metrics_union(_metric_files(spark, sf))))


# ---- J12-J16: segments on the validation rows ---------------------------------------------------

O.cte("vscored", ["scores", "valid_ids", "behavior"], """
SELECT s.TransactionID, s.y, s.p, b.TransactionAmt, b.DT_week, b.DeviceType_norm
FROM scores s JOIN valid_ids v ON s.TransactionID = v.TransactionID JOIN behavior b ON b.TransactionID = s.TransactionID
WHERE s.model = 'm3'""")


def _edges_sql(x: str) -> str:
    q4 = "CAST([0.0, 0.25, 0.5, 0.75, 1.0] AS DOUBLE[])"
    q3 = "CAST([" + ", ".join(repr(v) for v in [i * (1.0 / 3) for i in range(3)] + [1.0]) + "] AS DOUBLE[])"
    q2 = "CAST([0.0, 0.5, 1.0] AS DOUBLE[])"
    xs = f"CAST({x} AS DOUBLE)"
    return f"""
(SELECT CASE WHEN u > 2 THEN list_sort(list_distinct(CASE least(4, u - 1) WHEN 4 THEN quantile_cont({xs}, {q4})
             WHEN 3 THEN quantile_cont({xs}, {q3}) ELSE quantile_cont({xs}, {q2}) END)) END AS edges
 FROM vscored, (SELECT len(list_distinct(quantile_cont({xs}, {q4}))) AS u FROM vscored) uu GROUP BY u)"""


def _seg_src(x: str, kind: str) -> str:
    return (f"(SELECT '{kind}' AS segment_type, CAST(greatest(len(list_filter(e.edges, lambda v: v < CAST({x} AS DOUBLE))) - 1, 0) "
            f"AS VARCHAR) AS segment, y, p FROM vscored, {_edges_sql(x)} e WHERE e.edges IS NOT NULL)")


O.cte("seg_amount_src", ["vscored"], _seg_src("TransactionAmt", "amount"))
O.cte("seg_week_src", ["vscored"], _seg_src("DT_week", "week"))
O.cte("seg_device_src", ["vscored"], "SELECT 'device' AS segment_type, DeviceType_norm AS segment, y, p FROM vscored "
                                     "WHERE DeviceType_norm IS NOT NULL")


def _vscored(spark, sf):
    sc = _scores(spark, sf).where(F.col("model") == "m3")
    valid = SP.split_index(fx.tx(spark, sf))
    ctx = stages(spark, sf, until="behavior").behavior.select("TransactionID", "TransactionAmt", "DT_week", "DeviceType_norm")
    # stored once: the quantiles' passes and every metric read it
    return cut_lineage(sc.join(valid, "TransactionID", "inner").join(ctx, "TransactionID", "inner"), "scored")


@query("quantile_bins", w(f"""
SELECT TransactionID, TransactionAmt, CAST(greatest(len(list_filter(e.edges, lambda v: v < TransactionAmt)) - 1, 0) AS INTEGER)
       AS bin FROM vscored, {_edges_sql('TransactionAmt')} e""", "vscored"))
def quantile_bins(spark, sf):
    """Quartile bins of the validation amounts (qcut rules: duplicate edges dropped, right-closed)."""
    out, _ = V.quantile_bins(_vscored(spark, sf), "TransactionAmt")
    return out.select("TransactionID", "TransactionAmt", "bin")


@query("segment_amount", w(f"SELECT * FROM {metrics_sql('seg_amount_src', ['segment_type', 'segment'])} m",
                           "seg_amount_src"))
def segment_amount(spark, sf):
    """N, AUC, accuracy, precision, recall, F1 per amount quartile bin of the validation rows."""
    return V.segment_amount(_vscored(spark, sf))


@query("segment_week", w(f"SELECT * FROM {metrics_sql('seg_week_src', ['segment_type', 'segment'])} m", "seg_week_src"))
def segment_week(spark, sf):
    """The same per week bin."""
    return V.segment_week(_vscored(spark, sf))


@query("segment_device", w(f"SELECT * FROM {metrics_sql('seg_device_src', ['segment_type', 'segment'])} m",
                           "seg_device_src"))
def segment_device(spark, sf):
    """The same per normalised device type (AUC NULL for a one-class segment)."""
    return V.segment_device(_vscored(spark, sf))


@query("segment_metrics", w(" UNION ALL ".join(
    f"SELECT * FROM {metrics_sql(src, ['segment_type', 'segment'])} m{i}"
    for i, src in enumerate(["seg_amount_src", "seg_week_src", "seg_device_src"])),
    "seg_amount_src", "seg_week_src", "seg_device_src"))
def segment_metrics(spark, sf):
    """The three segment tables stacked."""
    return V.segment_all(_vscored(spark, sf))


# ---- H3, H4, K2-K4: importance and contribution tables -----------------------------------------

O.cte("imp", ["phi"], "SELECT feature, avg(abs(phi)) AS importance FROM phi GROUP BY feature")


@query("shap_global", w(f"SELECT * FROM imp ORDER BY importance DESC, feature LIMIT {DEFAULT.top_display}", "imp"))
def shap_global(spark, sf):
    """K2: mean |contribution| per feature, the 40 largest."""
    return K.shap_global(fx.phi(spark, sf))


@query("select_top_features", w(f"""
SELECT feature, importance FROM imp WHERE importance > 0 OR (SELECT max(importance) FROM imp) <= 0
ORDER BY importance DESC, feature LIMIT {DEFAULT.top_n_features}""", "imp"))
def select_top_features(spark, sf):
    """H3: features with importance > 0, at most 300, importance = mean |contribution| per feature."""
    return S.select_top_features(K.feature_importance(fx.phi(spark, sf)))


@query("importance_top40", w(f"SELECT * FROM imp ORDER BY importance DESC, feature LIMIT {DEFAULT.top_display}", "imp"))
def importance_top40(spark, sf):
    """H4: the 40 most important features."""
    return S.importance_top(K.feature_importance(fx.phi(spark, sf)))


@query("shap_beeswarm", w(f"""
SELECT p.TransactionID, p.feature, p.value, p.phi FROM phi p
JOIN (SELECT feature FROM imp ORDER BY importance DESC, feature LIMIT {DEFAULT.top_display}) t ON p.feature = t.feature""",
                          "phi", "imp"))
def shap_beeswarm(spark, sf):
    """K3: (id, feature, value, contribution) points of the 40 top features."""
    return K.shap_beeswarm(fx.phi(spark, sf))


@query("shap_local", w(f"""
SELECT feature, value, phi AS shap_value, CASE WHEN phi > 0 THEN '{K.POS_COLOR}' ELSE '{K.NEG_COLOR}' END AS color,
       printf('%s (%.3f)', feature, value) AS label, CAST(rn AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (ORDER BY abs(phi) DESC, feature) AS rn FROM phi
      WHERE TransactionID = coalesce((SELECT min(TransactionID) FROM phi WHERE y = 1), (SELECT min(TransactionID) FROM phi))) t
WHERE rn <= {DEFAULT.shap_top_local}""", "phi"))
def shap_local(spark, sf):
    """K4: the first fraud row's (else first row's) 20 largest |contributions| with sign colour and label."""
    return K.shap_local(fx.phi(spark, sf))
