"""The corpus pipeline: each stage reads what its predecessor wrote.

STAGES are applied to ``documents`` in order; every stage but the last returns the columns of documents. Between two
stages of ``run`` the rows are written as Parquet in the shared checkpoint folder and read again.

Defined results: null and empty texts have no language and go in the first stage; rows with a null id are never near-duplicates
of others and stay, equal rows (id and text) are one document after the second stage; null sources are a source; very long
texts are never cut before the mix; an empty table stays empty through all stages; other columns are kept up to the last
stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskflow.llm import lang_id, minhash_join, mix, packing, secret_scan
from riskflow.llm.common import bounded_batches, read, stage
from riskflow.session import ship_package


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    bounded_batches(spark)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which the rank-order profiles find no language."""
    _prepare(spark)
    return lang_id.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each near-duplicate component (five-word shingles, similarity 0.8)."""
    _prepare(spark)
    return minhash_join.keep_first(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; all documents stay."""
    _prepare(spark)
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats, cuts or leaves out documents so that each source takes its target."""
    _prepare(spark)
    return mix.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 1024 tokens."""
    _prepare(spark)
    return packing.pack(docs)


STAGES = [("language_id", languages), ("near_duplicates", near_duplicates),
          ("secret_scan", secrets), ("source_mix", mixture), ("best_fit_packing", packed)]

#: Language profiles and minimum hashes are beyond SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
