"""Query catalog: one entry per operator of the inventory, each a Spark callable (spark, sf_dir) -> DataFrame
and, where SQL can express it, the DuckDB oracle text over the same tables.

The registry is filled by the ``queries_*`` modules of this package.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn

    return deco


def load_all() -> dict[str, Query]:
    import importlib

    for m in ["queries_base", "queries_encode", "queries_eval", "queries_models"]:
        importlib.import_module(f"riskflow.plans.{m}")
    return REGISTRY
