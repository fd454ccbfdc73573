"""Invariants of the rows-only operators (models, explanation, persistence, scoring, streaming)."""

import random
from types import SimpleNamespace

import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskflow.plans.catalog import load_all

from conftest import SMALL

REG = load_all()


def test_models_probabilities_and_auc(spark):
    from riskflow.plans.queries_models import CATALOG, matrix
    from riskflow.operators import models as M

    mx = matrix(spark, "/root/testdata/sf0.01")
    _, sc, met = M.gbt_baseline(mx, CATALOG)
    assert sc.where((F.col("p") < 0) | (F.col("p") > 1)).count() == 0
    assert met.first()["auc"] > 0.6


def test_stream_equals_batch(spark):
    batch = REG["score_batch"].fn(spark, SMALL)
    stream = REG["score_stream"].fn(spark, SMALL)
    a = {r["TransactionID"]: (round(r["p"], 12), r["label"], r["risk_level"]) for r in batch.collect()}
    b = {r["TransactionID"]: (round(r["p"], 12), r["label"], r["risk_level"]) for r in stream.collect()}
    assert a == b and len(a) > 0


def test_kfold_and_search_shapes(spark):
    k = REG["kfold_cv"].fn(spark, SMALL).collect()
    assert [r["fold"] for r in k] == ["1", "2", "3", "4", "5", "mean"]
    assert sum(r["n_val"] for r in k[:5]) == REG["scan_table"].fn(spark, SMALL).count()
    log = REG["random_search"].fn(spark, SMALL)
    assert log.select("iter").distinct().count() == log.count()


def test_shapley_covers_all_rows(spark):
    """Every validation row is explained, each with every feature."""
    from riskflow.plans.queries_models import matrix

    sh = REG["shapley_values"].fn(spark, SMALL)
    n = matrix(spark, SMALL).valid.count()
    assert sh.select("TransactionID").distinct().count() == n
    assert sh.count() == n * sh.select("feature").distinct().count()
    assert sh.where(F.col("phi").isNull()).count() == 0


def test_search_maps_parameters():
    from riskflow.operators import models as M

    d = M.draws(165, 3)
    assert d == M.draws(165, 3) and all(32 <= p["num_leaves"] < 128 and 200 <= p["n_estimators"] < 600 for p in d)
    for p in d:
        est, fitted = M.search_estimator(p, 5000.0)
        assert est.getMaxIter() == fitted["maxIter"] == p["n_estimators"]
        assert est.getMinInfoGain() == p["min_split_gain"] / 5000.0


def test_save_load_and_matrix(spark):
    reloaded = REG["model_save_load"].fn(spark, SMALL)
    assert reloaded.where(F.col("p").isNull()).count() == 0
    m = REG["sink_matrix"].fn(spark, SMALL)
    assert "features" in m.columns and m.count() > 0
    imp = REG["model_importance"].fn(spark, SMALL)
    assert imp.where("importance < 0 or splits < 0").count() == 0


def test_stream_resumes_from_checkpoint(spark, tmp_path):
    """A second availableNow run with the same checkpoint scores only the files that arrived since."""
    from riskflow.plans.queries_models import _manual
    from riskflow.streaming.score_stream import RECORD_SCHEMA, score_stream

    feats, clf, _, _, m = _manual(spark, SMALL)
    rec = m.select(*[F.col(f.name).cast(f.dataType) for f in RECORD_SCHEMA.fields])
    src, sink, ckpt = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    rec.where("TransactionID % 2 = 0").write.mode("append").parquet(src)
    first = score_stream(spark, src, sink, ckpt, feats, clf).count()
    rec.where("TransactionID % 2 = 1").write.mode("append").parquet(src)
    out = score_stream(spark, src, sink, ckpt, feats, clf)
    assert first == rec.where("TransactionID % 2 = 0").count()
    assert out.count() == rec.count() == out.select("TransactionID").distinct().count()


def test_logistic_fits_all_training_rows(spark, monkeypatch):
    """The fit gets every training row, also above 200,000, and its penalty is one over their number."""
    from riskflow.operators import models as M

    d = spark.range(200_300).select(F.col("id").alias("TransactionID"), (F.col("id") % 3 == 0).cast("int").alias("isFraud"),
                                    array_to_vector(F.array((F.col("id") % 3 + F.col("id") % 7).cast("double"))).alias("features"))
    seen, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: seen.append((df.count(), self.getRegParam())) or fit(self, df))
    _, scores, _ = M.logistic_baseline(M.Matrix(d, d.limit(50), ["x"]))
    assert seen == [(200_300, pytest.approx(1 / 200_300))] and scores.count() == 50


def test_registered_fits_have_the_reference_sizes(spark, monkeypatch):
    """(trees, depth) that the queries ask for; the fits themselves are cut short here."""
    from riskflow.plans import queries_models as Q

    rng = random.Random(5)
    rows = [(i, int(i % 3 == 0), float(i % 3 == 0) + rng.random(), rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud int, a double, b double")
    monkeypatch.setattr(Q, "stages", lambda *_, **__: SimpleNamespace(crossed=df))
    monkeypatch.setattr(Q, "_MEMO", {})
    seen, fit = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, d: seen.append((self.getMaxIter(), self.getMaxDepth())) or fit(
        self.copy({self.maxIter: 1, self.maxDepth: 2}), d))
    want = {"model_importance": [(200, 6)] * 2, "gbt_baseline": [(300, 6)], "xgb_baseline": [(300, 6)], "cat_baseline": [(300, 6)],
            "gbt_tuned": [(500, 5)] * 2 + [(500, 6)] * 2, "kfold_cv": [(300, 6)] * 5, "logistic_baseline": []}
    for name, sizes in want.items():  # the first one's matrix serves all
        seen.clear()
        REG[name].fn(spark, "own rows")
        assert sorted(seen) == sizes, name
