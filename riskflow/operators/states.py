"""Mergeable states (A4): what the encoders need to know about a batch, so that a new batch is added, not refitted on.

A state row ``(col, key, n, n_y, sum_y, n_v, sum_v, first, version)`` counts the rows of one value of one column (NULL is a
value of its own), count and sum of the label and of the amount, and the smallest row key. All of these add up or take a minimum,
so the states of two batches merge into the state of both with one aggregate, combined before the shuffle. The encoders'
maps (G1, G2, G4, F12) are views of a state.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.encode import MISSING_TOKEN
from riskflow.operators.ordered import consecutive_codes
from riskflow.settings import DEFAULT, Settings
from riskflow.sources.tables import sink_stage

VERSION = 1
STATE = ("col string, key string, n bigint, n_y bigint, sum_y double, n_v bigint, sum_v double, first bigint, version int")


def _number(c):
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def value_state(df: DataFrame, cols: list[str], s: Settings = DEFAULT) -> DataFrame:
    """The state of every value of ``cols`` over the rows of ``df`` (label, amount and row key as in ``s``)."""
    e = df.select(_number(s.target).alias("y"), _number(s.amount_col).alias("v"), F.col(s.id_col).cast("bigint").alias("id"),
                  F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("key")) for c in cols]))
                  .alias("e"))
    return e.groupBy("e.col", "e.key").agg(
        F.count(F.lit(1)).alias("n"), F.count("y").alias("n_y"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("sum_y"), F.count("v").alias("n_v"),
        F.coalesce(F.sum("v"), F.lit(0.0)).alias("sum_v"), F.min("id").alias("first"), F.lit(VERSION).alias("version"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all batches together. States of another version raise when the result is read."""
    known = F.when(F.col("version") == VERSION, F.col("version")).otherwise(
        F.raise_error(F.concat(F.lit("state version "), F.col("version").cast("string"))).cast("int"))
    d = reduce(DataFrame.unionByName, states).withColumn("version", known)
    return d.groupBy("col", "key").agg(
        F.sum("n").alias("n"), F.sum("n_y").alias("n_y"), F.sum("sum_y").alias("sum_y"), F.sum("n_v").alias("n_v"), F.sum("sum_v").alias("sum_v"),
        F.min("first").alias("first"), F.max("version").alias("version"))


def save_value_state(state: DataFrame, path: str) -> DataFrame:
    return sink_stage(state, path)


def load_value_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def freq_view(state: DataFrame) -> DataFrame:
    """G1's map (col, key, value = share of all rows of the column's state); NULL is no key."""
    total = state.groupBy("col").agg(F.sum("n").alias("total"))  # one row per column
    return state.where("key is not null").join(total, "col").select(
        "col", "key", (F.col("n") / F.col("total").cast("double")).alias("value"))


def target_view(state: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """G2's map (col, key, value = label mean) of the columns with 2 to ``max_te_card`` values, and per column the mean of all
    rows as key NULL."""
    per_col = state.groupBy("col").agg(F.count("key").alias("values"), F.sum("n_y").alias("rows"), F.sum("sum_y").alias("y"))
    gated = per_col.where(F.col("values").between(2, s.max_te_card))
    means = state.where("key is not null").join(gated.select("col"), "col").select(
        "col", "key", F.try_divide("sum_y", "n_y").alias("value"))
    return means.unionByName(gated.select("col", F.lit(None).cast("string").alias("key"), F.try_divide("y", "rows").alias("value")))


def label_view(state: DataFrame, col: str, s: Settings = DEFAULT) -> DataFrame:
    """G4's map (col, key, value = code in order of first appearance) of one column; NULL is ``__MISSING__``."""
    d = state.where(F.col("col") == col).select(F.coalesce("key", F.lit(MISSING_TOKEN)).alias("key"), "first")
    d = d.groupBy("key").agg(F.min("first").alias("_first"))
    codes = consecutive_codes(d, ["_first", "key"], code_col="value", s=s)
    return codes.select(F.lit(col).alias("col"), "key", F.col("value").cast("double").alias("value"))


def card_mean_view(state: DataFrame, col: str = DEFAULT.card_col) -> DataFrame:
    """F12's map (col, key, value = mean amount), and the mean of all rows (0 without any) as ``__global__``."""
    own = state.where(F.col("col") == col)
    means = own.where("key is not null and n_v > 0").select("col", "key", (F.col("sum_v") / F.col("n_v")).alias("value"))
    every = own.agg(F.coalesce(F.try_divide(F.sum("sum_v"), F.sum("n_v")), F.lit(0.0)).alias("value"))
    return means.unionByName(every.select(F.lit("__global__").alias("col"), F.lit(None).cast("string").alias("key"), "value"))
