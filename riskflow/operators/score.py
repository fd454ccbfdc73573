"""Scoring (L1, L2): score rows with a fitted model, attach business fields, label and risk band."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions.numeric import risk_level
from riskflow.operators.clean import BUSINESS_COLUMNS, project_business
from riskflow.operators.encode import ManualFeaturesModel
from riskflow.settings import DEFAULT, Settings
from riskflow.sources.layout import lookup
from riskflow.sources.tables import STATE_SCHEMA, load_state, sink_state


def with_prediction(scored: DataFrame, threshold: float = DEFAULT.decision_threshold) -> DataFrame:
    p = vector_to_array("probability")[1]
    return scored.withColumn("p", p).withColumn("label", (F.col("p") >= F.lit(threshold)).cast("int")) \
        .withColumn("risk_level", risk_level("p"))


class LinearModel:
    """Stored weights as a model: probability = 1 / (1 + exp(-(bias + weights . features))), in column expressions."""

    def __init__(self, weights: list[float], bias: float = 0.0, features_col: str = "features"):
        self.weights, self.bias, self.features_col = [float(w) for w in weights], float(bias), features_col

    def transform(self, df: DataFrame) -> DataFrame:
        terms = F.zip_with(vector_to_array(self.features_col), F.array(*[F.lit(w) for w in self.weights]), lambda x, w: x * w)
        z = F.aggregate(terms, F.lit(self.bias), lambda a, t: a + t)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))

    def save(self, spark: SparkSession, path: str) -> DataFrame:
        """The weights as state rows (col, key, value), by position; the bias is ``bias``."""
        rows = [("weight", str(i), w) for i, w in enumerate(self.weights)] + [("bias", None, self.bias)]
        return sink_state(spark.createDataFrame(rows, STATE_SCHEMA), path)

    @staticmethod
    def load(spark: SparkSession, path: str, features_col: str = "features") -> "LinearModel":
        rows = load_state(spark, path).collect()  # one per feature
        weights = {int(r["key"]): r["value"] for r in rows if r["col"] == "weight"}
        bias = next(r["value"] for r in rows if r["col"] == "bias")
        return LinearModel([weights[i] for i in range(len(weights))], bias, features_col)


def score_lookup(model, rows: DataFrame, context: DataFrame, s: Settings = DEFAULT, ids: list | None = None) -> DataFrame:
    """L1: the chosen rows' business fields, fraud probability and label (context joined by row key).

    ``ids`` chooses rows: the filter goes into both scans, before anything is scored or joined, and on tables of
    ``layout.sink_clustered`` reads only the row groups that can hold them. Without ``ids`` all rows are scored."""
    if ids is not None:
        rows, context = lookup(rows, ids, s.id_col), lookup(context, ids, s.id_col)
    scored = with_prediction(model.transform(rows)).select(s.id_col, "p", "label")
    ctx = project_business(context, BUSINESS_COLUMNS)
    return scored.join(ctx, s.id_col, "inner")


def assemble_manual(df: DataFrame, out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    from riskflow.operators.encode import MANUAL_FEATURES

    return VectorAssembler(inputCols=MANUAL_FEATURES, outputCol=out, handleInvalid="keep").transform(df)


def score_batch(features: ManualFeaturesModel, clf, records: DataFrame, keep: list[str] = ("TransactionID",),
                threshold: float = DEFAULT.decision_threshold) -> DataFrame:
    """L2: six-field records -> the app's nine features -> probability, label at 0.5, risk band."""
    keep = [c for c in keep if c in records.columns]
    x = assemble_manual(features.transform(records, keep=keep))
    return with_prediction(clf.transform(x), threshold).select(*keep, "p", "label", "risk_level")
