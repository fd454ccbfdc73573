"""Assembly and feature selection (H0, H1, H3-H7); model importance (H2) is in ``models``.

Per-column statistics (variance, correlation with the label) come from one
chunked aggregate pass; the result has one row per feature, so ranking it with a
plain window is bounded by the column count, not the row count.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.operators.clean import numeric_columns
from riskflow.operators.profile import _is_missing, wide_stat
from riskflow.settings import DEFAULT, Settings


def feature_columns(df: DataFrame, target: str = DEFAULT.target, exclude: list[str] = ()) -> list[str]:
    """Numeric columns except the label (ids and time stay in, as in the reference; ``exclude`` removes more)."""
    return [c for c in numeric_columns(df) if c != target and c not in exclude]


def assemble(df: DataFrame, cols: list[str] | None = None, target: str = DEFAULT.target,
             id_col: str = DEFAULT.id_col, out: str = "features", exclude: list[str] = ()) -> DataFrame:
    """H0: numeric columns to one vector (NULL/NaN kept as NaN), with the row key and label beside it."""
    cols = feature_columns(df, target, exclude) if cols is None else cols
    va = VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep")
    keep = [c for c in [id_col, target] if c in df.columns]
    src = df.select(*dict.fromkeys(keep + cols))
    return va.transform(src).select(*keep, out)


def variance_table(df: DataFrame, cols: list[str] | None = None, threshold: float = DEFAULT.variance_threshold,
                   target: str = DEFAULT.target, s: Settings = DEFAULT) -> DataFrame:
    """H1: population variance of each feature and whether it is above ``threshold``."""
    cols = feature_columns(df, target) if cols is None else cols
    v = wide_stat(df.select(*cols), lambda d, c: F.var_pop(F.col(c).cast("double")), "feature", "variance", s)
    return v.withColumn("kept", F.coalesce(F.col("variance") > F.lit(threshold), F.lit(False)))


def variance_filter(df: DataFrame, threshold: float = DEFAULT.variance_threshold, target: str = DEFAULT.target,
                    s: Settings = DEFAULT) -> tuple[DataFrame, list[str]]:
    """H1 applied: the kept feature columns (list bounded by the column count), others dropped."""
    kept = [r["feature"] for r in variance_table(df, None, threshold, target, s).where("kept").collect()]  # per column
    keep_other = [c for c in df.columns if c not in feature_columns(df, target)]
    return df.select(*keep_other, *kept), kept


def select_top_features(importance: DataFrame, n: int = DEFAULT.top_n_features) -> DataFrame:
    """H3: features with importance > 0, the ``n`` largest (name breaks ties); all features if none is > 0."""
    top = importance.agg(F.max("importance")).first()[0]
    ordered = importance.orderBy(F.desc("importance"), "feature")
    if top is None or top <= 0:
        return ordered
    return ordered.where(F.col("importance") > 0).limit(n)


def importance_top(importance: DataFrame, n: int = DEFAULT.top_display) -> DataFrame:
    """H4: the ``n`` most important features for display."""
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def leakage_corr(df: DataFrame, target: str = DEFAULT.target, cols: list[str] | None = None,
                 s: Settings = DEFAULT) -> DataFrame:
    """H5: Pearson correlation of each numeric column with the label over pairwise-complete rows.

    ``covar_pop / (stddev_pop(x) * stddev_pop(y where x present))`` with ``try_divide``: a constant column gives
    NULL (pandas gives NaN) instead of a division error.
    """
    cols = feature_columns(df, target) if cols is None else cols
    y = F.col(target).cast("double")
    # project each column's pairwise-complete (x, y) once; the aggregate then works on plain columns
    proj = []
    for i, c in enumerate(cols):
        present = ~_is_missing(df, c)
        proj += [F.when(present, F.col(c).cast("double")).alias(f"x{i}"), F.when(present, y).alias(f"y{i}")]
    sub = df.select(*proj)
    parts = []
    # three aggregates per column: a twentieth of the usual chunk keeps the generated code small enough to be compiled
    step = max(5, s.agg_chunk // 20)
    for i in range(0, len(cols), step):
        idx = range(i, min(i + step, len(cols)))
        row = sub.agg(*[F.try_divide(F.covar_pop(f"x{k}", f"y{k}"), F.stddev_pop(f"x{k}") * F.stddev_pop(f"y{k}"))
                        .alias(cols[k]) for k in idx])
        parts.append(row.unpivot([], [cols[k] for k in idx], "feature", "corr"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def leakage_top(corr: DataFrame, n: int = 30) -> DataFrame:
    """H6: the ``n`` first and ``n`` last features of the descending list (NULLs last, so they fall in the tail)."""
    # one row per feature: bounded by the column count. Order on corr rounded to 10 digits, so features with the
    # same correlation up to summation noise tie and fall back to the name order.
    w = Window.orderBy(F.desc_nulls_last(F.round("corr", 10)), "feature")
    ranked = corr.withColumn("pos", F.row_number().over(w)).withColumn("n_all", F.count(F.lit(1)).over(Window.partitionBy()))
    head = ranked.where(F.col("pos") <= n).withColumn("side", F.lit("top_pos"))
    tail = ranked.where(F.col("pos") > F.col("n_all") - n).withColumn("side", F.lit("top_neg"))
    return head.unionByName(tail).select("side", "pos", "feature", "corr")


def leakage_suspicious(corr: DataFrame, limit: float = 0.9) -> DataFrame:
    """H7: features with abs(corr) above ``limit``."""
    return corr.where(F.abs(F.col("corr")) > F.lit(limit))
