"""Evaluation (J1-J16, C4, M8, M10) over a long score table ``(id, group..., y, p)``.

Every metric is an aggregate of the score table. Rank-based metrics (AUC, ROC and
PR curves, average precision) first collapse ties (one row per distinct score and
group, map-side combined), then take running totals in descending score order with
``ordered_prefix`` - never a window over all scores of a model in one task.
AUC uses integer sums only, so it is exact:
``AUC = (2PN - 2 sum(pos * cumneg) + sum(pos * neg)) / 2PN``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.operators.quantiles import exact_quantiles
from riskflow.operators.ordered import ordered_prefix
from riskflow.settings import DEFAULT, Settings


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (scikit-learn's zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p",
              threshold: float = DEFAULT.decision_threshold) -> DataFrame:
    """Tn, fp, fn, tp at ``p >= threshold``."""
    pred = F.col(p) >= F.lit(threshold)
    pos = F.col(y) == 1

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")

    return scores.groupBy(*by).agg(
        cnt(~pred & ~pos).alias("tn"), cnt(pred & ~pos).alias("fp"),
        cnt(~pred & pos).alias("fn"), cnt(pred & pos).alias("tp"),
    )


def rates(conf: DataFrame) -> DataFrame:
    """J2 from J1: accuracy, precision, recall, F1 (zero denominators give 0)."""
    tp, fp, fn, tn = (F.col(c) for c in ["tp", "fp", "fn", "tn"])
    return conf.select(
        "*",
        _div0(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _div0(tp, tp + fp).alias("precision"),
        _div0(tp, tp + fn).alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def score_points(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p",
                 s: Settings = DEFAULT) -> DataFrame:
    """One row per (group, distinct score): pos, neg at that score and cum_pos / cum_neg at scores >= it."""
    by = list(by)
    d = scores.where(F.col(p).isNotNull()).groupBy(*by, p).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("bigint").alias("neg"),
    )
    return ordered_prefix(d, order=[-F.col(p)], by=by, sums=["pos", "neg"], s=s)


def _totals(points: DataFrame, by: list[str]) -> DataFrame:
    return points.groupBy(*by).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))


def roc_auc(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p", s: Settings = DEFAULT,
            points: DataFrame | None = None) -> DataFrame:
    """Exact ROC AUC per group, ties counted half; NULL when a group has one class."""
    by = list(by)
    pts = score_points(scores, by, y, p, s) if points is None else points
    a = pts.groupBy(*by).agg(
        F.sum("pos").alias("_P"), F.sum("neg").alias("_N"),
        F.sum(F.col("pos") * F.col("cum_neg")).alias("s1"), F.sum(F.col("pos") * F.col("neg")).alias("s2"),
    )
    pn2 = F.lit(2) * F.col("_P") * F.col("_N")
    auc = F.try_divide((pn2 - 2 * F.col("s1") + F.col("s2")).cast("double"), pn2.cast("double"))
    return a.select(*by, auc.alias("auc"))


def binary_metrics(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p",
                   threshold: float = DEFAULT.decision_threshold, s: Settings = DEFAULT) -> DataFrame:
    """J2 + J3: auc, accuracy, precision, recall, f1 per group (rows n beside them)."""
    by = list(by)
    if not by:
        raise ValueError("binary_metrics needs at least one group column")
    r = rates(confusion(scores, by, y, p, threshold))
    a = roc_auc(scores, by, y, p, s)
    same = F.lit(True)
    for c in by:  # null-safe: a NULL model is a group too
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"a.{c}"))
    j = r.alias("r").join(a.alias("a"), same, "left").select("r.*", "a.auc")
    return j.select(*by, (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n"),
                    "auc", "accuracy", "precision", "recall", "f1")


def business_cost(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p",
                  threshold: float = DEFAULT.decision_threshold, s: Settings = DEFAULT) -> DataFrame:
    """cost = fn_cost * FN + fp_cost * FP with the confusion counts."""
    c = confusion(scores, list(by), y, p, threshold)
    cost = F.lit(s.fn_cost) * F.col("fn") + F.lit(s.fp_cost) * F.col("fp")
    return c.select(*by, cost.cast("double").alias("cost"), "tn", "fp", "fn", "tp")


def thresholds(s: Settings = DEFAULT) -> list[float]:
    """``numpy.linspace(lo, hi, n)``: i * step + lo, the last point exactly hi."""
    n = s.n_thresholds
    step = (s.threshold_hi - s.threshold_lo) / (n - 1)
    return [i * step + s.threshold_lo for i in range(n - 1)] + [s.threshold_hi]


def threshold_cross(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p",
                    s: Settings = DEFAULT) -> DataFrame:
    """C4: confusion counts of every score against every threshold (``p >= t``), without a cross join.

    Each score goes to the highest threshold <= p (a 40-way comparison in the row), counts are summed per
    (group, threshold index), and a suffix sum over the 40 thresholds gives tp / fp at ``p >= t``.
    """
    by = list(by)
    ts = thresholds(s)
    arr = F.array(*[F.lit(t) for t in ts])
    idx = (F.size(F.filter(arr, lambda t: t <= F.col(p))) - 1).cast("int")
    counts = scores.groupBy(*by, idx.alias("ti")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("bigint").alias("neg"),
    )
    groups = counts.groupBy(*by).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    grid = groups.select(*by, "_P", "_N", F.posexplode(arr).alias("ti", "threshold"))
    g = grid.join(counts, [*by, "ti"], "left").fillna(0, subset=["pos", "neg"])
    w = Window.partitionBy(*by).orderBy(F.desc("ti")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = g.withColumn("tp", F.sum("pos").over(w)).withColumn("fp", F.sum("neg").over(w))
    return g.select(*by, "threshold", "tp", "fp", (F.col("_P") - F.col("tp")).alias("fn"),
                    (F.col("_N") - F.col("fp")).alias("tn"))


def threshold_metrics(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p",
                      s: Settings = DEFAULT) -> DataFrame:
    """Precision, recall, F1 at each of the 40 thresholds."""
    r = rates(threshold_cross(scores, by, y, p, s))
    return r.select(*by, "threshold", "precision", "recall", "f1")


def best_threshold(tm: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """The threshold with the highest F1 per group, the lowest threshold on ties (40 rows per group)."""
    w = Window.partitionBy(*by).orderBy(F.desc("f1"), "threshold")
    return tm.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def _class_totals(scores: DataFrame, by: list[str], y: str, p: str) -> DataFrame:
    """P and N per group straight from the score rows (a small aggregate; the ranked table is not re-read)."""
    return scores.where(F.col(p).isNotNull()).groupBy(*by).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("bigint").alias("_P"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("bigint").alias("_N"),
    )


def roc_curve(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p",
              s: Settings = DEFAULT) -> DataFrame:
    """(fpr, tpr) per distinct score from the highest, after (0, 0); a point is dropped when both of its
    second differences are zero (scikit-learn's drop_intermediate).

    Neighbours without self-joins: every ranked point is sent to its own rank and to ranks -1 / +1 (three narrow
    copies), and one ``groupBy(group, rank)`` gathers a point with its previous and next point."""
    by = list(by)
    pts = score_points(scores, by, y, p, s).select(*by, "_rank", F.col(p).alias("threshold"),
                                                   F.col("cum_pos").alias("tps"), F.col("cum_neg").alias("fps"))
    e = pts.select(*by, "threshold", "tps", "fps", F.col("_rank").alias("_src"),
                   F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("_d"))
    e = e.withColumn("_t", F.col("_src") + F.col("_d"))
    j = (F.col("_src") - F.col("_t"))  # 0: the point itself, -1: its previous point, +1: its next point

    def pick(c, k):
        return F.max(F.when(j == k, F.col(c)))

    g = e.groupBy(*by, "_t").agg(
        pick("threshold", 0).alias("threshold"), pick("tps", 0).alias("tps"), pick("fps", 0).alias("fps"),
        F.count(F.when(j == 0, 1)).alias("_own"),
        pick("tps", -1).alias("tp0"), pick("fps", -1).alias("fp0"), pick("tps", 1).alias("tp2"),
        pick("fps", 1).alias("fp2"),
    ).where(F.col("_own") == 1)
    keep = (F.col("tp0").isNull() | F.col("tp2").isNull()
            | (F.col("fp0") - 2 * F.col("fps") + F.col("fp2") != 0)
            | (F.col("tp0") - 2 * F.col("tps") + F.col("tp2") != 0))
    tot = _class_totals(scores, by, y, p)
    kept = g.where(keep).join(tot, by, "inner")
    curve = kept.select(*by, "threshold", F.try_divide(F.col("fps").cast("double"), F.col("_N")).alias("fpr"),
                        F.try_divide(F.col("tps").cast("double"), F.col("_P")).alias("tpr"))
    origin = tot.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
                        F.lit(0.0).alias("tpr"))
    return curve.unionByName(origin)


def pr_curve(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p",
             s: Settings = DEFAULT) -> DataFrame:
    """(precision, recall) at every distinct score, plus the end point (1, 0)."""
    by = list(by)
    pts = score_points(scores, by, y, p, s)
    tot = _class_totals(scores, by, y, p)
    j = pts.join(tot, by, "inner")
    recall = F.when(F.col("_P") == 0, F.lit(1.0)).otherwise(F.col("cum_pos") / F.col("_P"))
    curve = j.select(*by, F.col(p).alias("threshold"),
                     _div0(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                     recall.alias("recall"))
    end = tot.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                     F.lit(0.0).alias("recall"))
    return curve.unionByName(end)


def average_precision(scores: DataFrame, by: list[str] = ("model",), y: str = "y", p: str = "p",
                      s: Settings = DEFAULT) -> DataFrame:
    """Sum over distinct scores of (recall step) * precision = sum(pos * precision) / P."""
    by = list(by)
    pts = score_points(scores, by, y, p, s)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    a = pts.groupBy(*by).agg(F.sum(F.col("pos") * prec).alias("_s"), F.sum("pos").alias("_P"))
    return a.select(*by, F.try_divide(F.col("_s"), F.col("_P").cast("double")).alias("average_precision"))


def ensemble_avg(scores: DataFrame, id_col: str = "TransactionID", y: str = "y", p: str = "p",
                 model: str = "model", name: str = "Ensemble_avg", min_models: int = 2) -> DataFrame:
    """Mean probability over the models present, when at least ``min_models`` are; long form (id, model, y, p)."""
    n_models = scores.select(model).distinct().count()
    if n_models < min_models:
        return scores.limit(0).select(id_col, model, y, p)
    return scores.groupBy(id_col).agg(F.max(y).alias(y), F.avg(p).alias(p)).select(
        id_col, F.lit(name).alias(model), y, p)


def search_log(scores: DataFrame, y: str = "y", p: str = "p", model: str = "model", s: Settings = DEFAULT) -> DataFrame:
    """The random search's log: one row per candidate (here: per scored model, ``iter`` by model name) with
    auc, accuracy, precision, recall, f1, cost and the confusion counts."""
    m = binary_metrics(scores, [model], y, p, s=s)
    c = business_cost(scores, [model], y, p, s=s)
    j = m.join(c, model, "inner")
    return j.withColumn("iter", F.dense_rank().over(Window.orderBy(model)).cast("int"))  # one row per candidate


def search_argbest(log: DataFrame) -> DataFrame:
    """M8: lowest cost, ties to the higher AUC, then the earlier iteration."""
    return log.orderBy("cost", F.desc("auc"), "iter").limit(1)


# ---- quantile bins and segments -----------------------------------------------------------------


def _percentiles(df: DataFrame, x: str, probs: list[float], s: Settings) -> list[float]:
    return [v for v in exact_quantiles(df, [x], probs, s)[x] if v is not None]


def quantile_edges(df: DataFrame, x: str, s: Settings = DEFAULT) -> list[float] | None:
    """J12 edges: ``pd.qcut(x, min(4, u - 1), duplicates='drop')`` where u = distinct quartile points;
    None when u <= 2 (the reference skips the segment)."""
    qs = sorted(set(_percentiles(df, x, [0.0, 0.25, 0.5, 0.75, 1.0], s)))
    if len(qs) <= 2:
        return None
    q = min(4, len(qs) - 1)
    if q == 4:  # five distinct points are the edges themselves
        return qs
    probs = [i * (1.0 / q) for i in range(q)] + [1.0]
    return sorted(set(_percentiles(df, x, probs, s)))


def bin_of(x: Column | str, edges: list[float]) -> Column:
    """Right-closed bin index over ``edges``, the lowest edge included: (number of edges < x) - 1, at least 0."""
    x = F.col(x) if isinstance(x, str) else x
    arr = F.array(*[F.lit(float(e)) for e in edges])
    return F.greatest(F.size(F.filter(arr, lambda e: e < x)) - 1, F.lit(0)).cast("int")


def quantile_bins(df: DataFrame, x: str, out: str = "bin", s: Settings = DEFAULT) -> tuple[DataFrame, list[float] | None]:
    edges = quantile_edges(df, x, s)
    if edges is None:
        return df.withColumn(out, F.lit(None).cast("int")), None
    return df.withColumn(out, bin_of(x, edges)), edges


def segment_metrics(scored: DataFrame, segment_type: str, segment: Column, y: str = "y", p: str = "p",
                    s: Settings = DEFAULT) -> DataFrame:
    """J13-J15 core: n, auc (NULL for one class), accuracy, precision, recall, f1 per segment value."""
    d = scored.select(F.lit(segment_type).alias("segment_type"), segment.cast("string").alias("segment"), y, p)
    d = d.where(F.col("segment").isNotNull())
    return binary_metrics(d, ["segment_type", "segment"], y, p, s=s)


def segment_amount(scored: DataFrame, x: str = "TransactionAmt", s: Settings = DEFAULT, **kw) -> DataFrame | None:
    edges = quantile_edges(scored, x, s)
    if edges is None:
        return None
    return segment_metrics(scored, "amount", bin_of(x, edges), s=s, **kw)


def segment_week(scored: DataFrame, x: str = "DT_week", s: Settings = DEFAULT, **kw) -> DataFrame | None:
    edges = quantile_edges(scored, x, s)
    if edges is None:
        return None
    return segment_metrics(scored, "week", bin_of(x, edges), s=s, **kw)


def segment_device(scored: DataFrame, x: str = "DeviceType_norm", s: Settings = DEFAULT, **kw) -> DataFrame | None:
    if x not in scored.columns:
        return None
    return segment_metrics(scored, "device", F.col(x), s=s, **kw)


def segment_all(scored: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """The three segment tables stacked."""
    parts = [t for t in (segment_amount(scored, s=s), segment_week(scored, s=s), segment_device(scored, s=s))
             if t is not None]
    out = parts[0]
    for t in parts[1:]:
        out = out.unionByName(t)
    return out


# ---- metric files ------------------------------------------------------------------------------

# Fixed values (reference): order in which the metric files are stacked.
METRIC_SOURCES = ["baseline", "tuned", "ensemble", "more_models", "cost_sensitive"]


def metrics_union(tables: dict[str, DataFrame]) -> DataFrame:
    """The metric tables present, stacked in the fixed source order; missing columns are NULL.
    Each table carries ``row_order`` (its row position); ``src_order`` is added here."""
    out = None
    for i, name in enumerate(METRIC_SOURCES):
        if name not in tables:
            continue
        t = tables[name].withColumn("src", F.lit(name)).withColumn("src_order", F.lit(i))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def metrics_latest(union: DataFrame) -> DataFrame:
    """One row per model, the last in stacking order; a NULL model is one key (pandas drop_duplicates)."""
    w = Window.partitionBy("model").orderBy(F.desc("src_order"), F.desc("row_order"))  # one row per metric line
    return union.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
