"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's check)."""

from __future__ import annotations

import math

import duckdb

from riskflow.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) + 0.0
    if hasattr(v, "toArray"):
        return tuple(round(float(x), digits) for x in v.toArray())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def rows_key(rows, cols, digits):
    out = []
    for r in rows:
        out.append(tuple(_norm(r[c], digits) for c in cols))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


_TYPES = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
          "BooleanType": "BOOLEAN", "FloatType": "FLOAT", "TimestampType": "TIMESTAMP", "TimestampNTZType": "TIMESTAMP",
          "ShortType": "SMALLINT", "ByteType": "TINYINT"}


def compare_types(spark_df, sql: str, con):
    sp = {f.name.lower(): _TYPES.get(type(f.dataType).__name__, str(f.dataType)) for f in spark_df.schema.fields}
    du = {r[0].lower(): r[1] for r in con.execute(f"DESCRIBE ({sql})").fetchall()}
    diff = {k: (v, du.get(k)) for k, v in sp.items() if v != du.get(k)}
    assert not diff, f"column types differ (spark, duckdb): {diff}"


def compare(spark_df, sql: str, con, digits: int = 6):
    compare_types(spark_df, sql, con)
    sp_cols = sorted(spark_df.columns)
    rows = [r.asDict() for r in spark_df.collect()]
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
    assert sorted(dcols) == sp_cols, f"columns differ: spark={sp_cols} duck={sorted(dcols)}"
    assert len(rows) == len(drows), f"row count differs: spark={len(rows)} duck={len(drows)}"
    a = rows_key(rows, sp_cols, digits)
    b = rows_key(drows, sp_cols, digits)
    diffs = [(x, y) for x, y in zip(a, b) if not _close(x, y)]
    if diffs:
        raise AssertionError(f"values differ (first): {diffs[:5]}")
    return len(rows)


def _close(x, y, rel=1e-9, abs_=1e-6):
    if isinstance(x, tuple) and isinstance(y, tuple):
        return len(x) == len(y) and all(_close(a, b) for a, b in zip(x, y))
    if isinstance(x, float) and isinstance(y, float):
        return abs(x - y) <= max(abs_, rel * max(abs(x), abs(y)))
    return x == y
