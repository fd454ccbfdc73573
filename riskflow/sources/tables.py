"""Scans and sinks (A1-A6): typed reads, stage writes, reports, fitted states, matrices, models.

Everything is a DataFrame in and a DataFrame out; a sink writes and returns the
re-read table so that a plan can continue from the written copy (lineage cut).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.numeric import nan_to_null
from riskflow.sources.infer import scan_csv

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None,
               header: bool = True) -> DataFrame:
    """A1: full read of a table. CSV without a schema is typed from its values (``infer``; its quarantined records are
    ``infer.scan_csv``'s to report); a stage that is read again takes the schema it was written with."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None:
            return scan_csv(spark, path).rows
        return _nan_free(reader.option("header", header).option("nanValue", "NaN").csv(path))
    return _nan_free(reader.format(fmt).load(path))


def _nan_free(df: DataFrame) -> DataFrame:
    """NaN to NULL in the floating-point columns: NaN is pandas' missing marker."""
    return df.select(*[nan_to_null(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, (T.FloatType, T.DoubleType))
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sink_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] = ()) -> DataFrame:
    """A2: write a stage (overwrite) and return the table read back from storage."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
        return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)
    w.format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def report(section: str, df: DataFrame, key: str, value: str) -> DataFrame:
    """A3: a report section as rows (section, key, value) - text rendering is left to the reader."""
    return df.select(
        F.lit(section).alias("section"),
        F.col(key).cast("string").alias("key"),
        F.col(value).cast("string").alias("value"),
    )


def sink_report(parts: list[DataFrame], path: str) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return sink_stage(out, path)


STATE_SCHEMA = "col string, key string, value double"


def sink_state(state: DataFrame, path: str) -> DataFrame:
    """A4: fitted maps (medians, frequency and target maps) as (col, key, value) rows in Parquet."""
    return sink_stage(state.select("col", "key", F.col("value").cast("double")), path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def sink_matrix(df: DataFrame, path: str, features_col: str = "features", label: str = "isFraud",
                id_col: str = "TransactionID") -> DataFrame:
    """A5: the assembled matrix (id, label, vector) with feature names kept in the ML attribute metadata,
    plus a names table at ``path + '_names'``."""
    out = sink_stage(df.select(id_col, label, features_col), path)
    names = feature_names(df, features_col)
    spark = df.sparkSession
    spark.createDataFrame([(i, n) for i, n in enumerate(names)], "idx int, feature string") \
        .write.mode("overwrite").parquet(path + "_names")
    return out


def feature_names(df: DataFrame, features_col: str = "features") -> list[str]:
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    pairs = []
    for group in attrs.values():
        pairs.extend((a["idx"], a["name"]) for a in group)
    return [n for _, n in sorted(pairs)]


def model_save(model, path: str):
    """Persist a fitted Spark ML model / pipeline."""
    model.write().overwrite().save(path)
    return path


def model_load(path: str):
    """The saved model, of the class that its metadata names."""
    import importlib
    import json

    text = SparkSession.getActiveSession().read.text(path + "/metadata").first()[0]
    module, name = json.loads(text)["class"].replace("org.apache.spark.ml", "pyspark.ml").rsplit(".", 1)
    if name == "PipelineModel":
        module = "pyspark.ml"
    return getattr(importlib.import_module(module), name).load(path)
