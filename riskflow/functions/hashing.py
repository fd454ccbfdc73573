"""Deterministic 32-bit hash of (value, salt), identical in Spark and DuckDB.

``h(x, salt) = int(md5(str(x) || '|' || salt)[:8], 16)``; used for splits,
samples and the test fixtures. Being a pure function of the row key, it makes
every split reproducible without row positions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(x: Column | str, salt: Column | str) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    salt = F.lit(salt) if isinstance(salt, str) else salt
    digest = F.md5(F.concat(x.cast("string"), F.lit("|"), salt))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash32_sql(x: str, salt: str) -> str:
    """DuckDB text of the same hash (``salt`` is an SQL expression)."""
    return f"(('0x' || substr(md5(CAST({x} AS VARCHAR) || '|' || {salt}), 1, 8))::BIGINT)"
