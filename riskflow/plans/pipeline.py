"""The feature pipeline as one lazy plan with explicit breaks where the schema depends on the data.

``merge -> drop sparse -> drop constant -> median fill -> text fill -> time -> device -> e-mail ->
behaviour -> frequency -> target mean -> cross``. D1, D2 and the encoders' gate each collect one small
statistics row; ``checkpoint=True`` cuts the lineage into the shared checkpoint folder after the
behaviour stage (the widest plan), which is what a cluster run wants.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.operators import behavior, clean, encode, features
from riskflow.operators import evaluate as V
from riskflow.operators import models as M
from riskflow.session import cut_lineage
from riskflow.settings import DEFAULT, Settings
from riskflow.sources import fixtures


def merge_identity(tx: DataFrame, identity: DataFrame, key: str = DEFAULT.id_col) -> DataFrame:
    """Left outer equi-join on the row key; unmatched identity columns are NULL."""
    return tx.join(identity, key, "left")


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_identity(fixtures.tx(spark, sf_dir), fixtures.identity(spark, sf_dir))


@dataclass
class Stages:
    merged: DataFrame
    dropped_missing: list[str] = field(default_factory=list)
    dropped_constant: list[str] = field(default_factory=list)
    medians: DataFrame | None = None
    filled: DataFrame | None = None
    timed: DataFrame | None = None
    device: DataFrame | None = None
    email: DataFrame | None = None
    behavior: DataFrame | None = None
    freq: DataFrame | None = None
    freq_state: DataFrame | None = None
    te: DataFrame | None = None
    te_state: DataFrame | None = None
    te_global: float | None = None
    crossed: DataFrame | None = None


def clean_stage(df: DataFrame, s: Settings = DEFAULT) -> tuple[DataFrame, list[str], list[str], DataFrame]:
    """D1-D4 from one fused statistics pass over the input."""
    return clean.clean_with_stats(df, s)


def derive_stage(df: DataFrame) -> DataFrame:
    return features.add_email_features(features.add_device_features(features.add_time_features(df)))


LEVELS = ["filled", "email", "behavior", "crossed"]


def advance(st: Stages, until: str = "crossed", s: Settings = DEFAULT, checkpoint: bool = True) -> Stages:
    """Compute the stages of ``st`` up to ``until`` (``LEVELS``), continuing from the last one already there.
    With ``checkpoint`` the merged, behaviour and encoded stages are stored (lineage cut)."""
    cut = cut_lineage if checkpoint else (lambda d: d)
    goal = LEVELS.index(until)
    if st.filled is None:
        st.merged = cut(st.merged)  # stored once: profiled several times, as the reference writes it once
        st.filled, st.dropped_missing, st.dropped_constant, st.medians = clean_stage(st.merged, s)
        st.timed = features.add_time_features(st.filled)
    if goal >= 1 and st.email is None:
        st.device = features.add_device_features(st.timed)
        st.email = features.add_email_features(st.device)  # a projection: not stored
    if goal >= 2 and st.behavior is None:
        st.behavior = cut(behavior.behavior_features(st.email, s))
    if goal >= 3 and st.crossed is None:
        enc = encode.encode_all(st.behavior, s.target, s=s)
        st.freq_state, st.te_state, st.te_global = enc.freq_state, enc.te_state, enc.te_global
        st.crossed = cut(features.add_cross_features(enc.df))
        st.te = st.freq = st.crossed
    return st


def run(df: DataFrame, s: Settings = DEFAULT, until: str = "crossed", checkpoint: bool = True) -> Stages:
    """Run the pipeline on the merged table ``df`` up to ``until``."""
    return advance(Stages(merged=df), until, s, checkpoint)


_MEMO: dict = {}


def stages(spark: SparkSession, sf_dir: str, s: Settings = DEFAULT, until: str = "crossed") -> Stages:
    """The pipeline over the fixture tables of ``sf_dir``, computed once per session up to the deepest stage
    asked for so far and reused by the queries."""
    key = (spark.sparkContext.applicationId, sf_dir, s)
    if key not in _MEMO:
        _MEMO[key] = Stages(merged=merged(spark, sf_dir))
    return advance(_MEMO[key], until, s)


def train_report(mx: M.Matrix, context: DataFrame, s: Settings = DEFAULT) -> dict[str, DataFrame]:
    """The training run on one matrix: baselines (M1, M2), the tuned fit (M3) and the other boosters (M5, M6), their average (M10),
    the metric tables stacked in source order (J10), the latest line per model (J11) and the average's segments (J16).

    ``context`` has the business columns of the rows by row key. Every fit's score table is stored once and all tables
    are aggregates of these."""
    fits = {"baseline": [M.logistic_baseline, M.gbt_baseline], "tuned": [M.gbt_tuned], "more_models": [M.xgb_baseline, M.cat_baseline]}
    scores = {k: [fn(mx, s)[1] for fn in fns] for k, fns in fits.items()}
    stacked = None
    for t in (t for ts in scores.values() for t in ts):
        stacked = t if stacked is None else stacked.unionByName(t)
    stacked = cut_lineage(stacked, "all-scores")
    ensemble = cut_lineage(V.ensemble_avg(stacked), "ensemble")
    tables = {}
    for k, ts in {**scores, "ensemble": [stacked, ensemble]}.items():
        every = ts[0]
        for t in ts[1:]:
            every = every.unionByName(t)
        # one row per model of the file: a global window over a handful of rows
        tables[k] = V.binary_metrics(every, ["model"], s=s).withColumn("row_order", F.dense_rank().over(Window.orderBy("model")) - 1)
    metrics = cut_lineage(V.metrics_union(tables), "metrics")
    rows = ensemble.join(context.select(s.id_col, "TransactionAmt", "DT_week", "DeviceType_norm"), s.id_col)
    return {"scores": stacked, "ensemble": ensemble, "metrics": metrics, "latest": V.metrics_latest(metrics),
            "segments": cut_lineage(V.segment_all(cut_lineage(rows, "scored"), s), "segments")}
