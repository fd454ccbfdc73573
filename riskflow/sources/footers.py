"""Column statistics from Parquet footers.

Counts, missing values and extremes of a stored table stand in the footers of its files. With Spark's aggregate push-down the
scan answers ``count`` and ``min`` / ``max`` from them and reads no column. What a footer cannot say is read from the columns
that need it, and only from those: NaN in a floating-point column (unless Spark wrote the file, whose footers have no extremes
where a NaN is), extremes of text and time, and columns whose footers lack statistics (row groups without a value among them).
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.settings import DEFAULT, Settings

_FLOATS = (T.FloatType, T.DoubleType)
#: Types whose extremes the push-down takes from a footer.
_EXTREMES = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)
_SIMPLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_SMALL = 4  # columns left of a failed push-down that are read instead of split further


@dataclass
class ColumnStats:
    """``present``: values neither NULL nor NaN; ``constant``: at most one distinct value (None: a type without an order)."""

    rows: int
    nulls: int
    present: int
    constant: bool | None
    from_footer: bool


def pushed_down(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` in a session of its own, in which Parquet scans take aggregates."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path)


def _try(df: DataFrame, cols: list[str], aggs, out: dict) -> list[str]:
    """Fill ``out`` with the row of ``aggs(c)`` for the columns that the footers answer; returns the others."""
    if not cols:
        return []
    try:
        row = df.agg(*[a.alias(f"a{i}_{j}") for i, c in enumerate(cols) for j, a in enumerate(aggs(c))]).first()
    except (Py4JJavaError, PySparkException):
        if len(cols) <= _SMALL:
            return cols
        half = len(cols) // 2
        return _try(df, cols[:half], aggs, out) + _try(df, cols[half:], aggs, out)
    for i, c in enumerate(cols):
        out[c] = [row[f"a{i}_{j}"] for j in range(len(aggs(c)))]
    return []


def table_stats(spark: SparkSession, path: str, spark_written: bool = False, s: Settings = DEFAULT) -> dict[str, ColumnStats]:
    """Statistics of every column of the Parquet table at ``path``, from its footers where they tell.

    ``spark_written``: the files are Spark's own, so a floating-point column with extremes in every footer has no NaN.
    """
    plain, df = spark.read.parquet(path), pushed_down(spark, path)
    kinds = {f.name: f.dataType for f in plain.schema.fields}
    rows = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    counts: dict[str, list] = {}
    ends: dict[str, list] = {}
    name = lambda c: F.col(f"`{c}`")
    names = list(kinds)
    for i in range(0, len(names), s.agg_chunk):
        chunk = names[i: i + s.agg_chunk]
        _try(df, [c for c in chunk if isinstance(kinds[c], _SIMPLE)], lambda c: [F.count(name(c))], counts)
        able = [c for c in chunk if isinstance(kinds[c], _EXTREMES) and counts.get(c, [0])[0]
                and (spark_written or not isinstance(kinds[c], _FLOATS))]
        _try(df, able, lambda c: [F.min(name(c)), F.max(name(c))], ends)
    out, read = {}, []
    for c, kind in kinds.items():
        n = counts.get(c, [None])[0]
        if n == 0:
            out[c] = ColumnStats(rows, rows, 0, True, True)
        elif c in ends:
            out[c] = ColumnStats(rows, rows - n, n, ends[c][0] == ends[c][1], True)
        else:
            read.append(c)
    for i in range(0, len(read), max(10, s.agg_chunk // 4)):
        chunk = read[i: i + max(10, s.agg_chunk // 4)]
        aggs = []
        for k, c in enumerate(chunk):
            x = F.when(~F.isnan(name(c)), name(c)) if isinstance(kinds[c], _FLOATS) else name(c)
            aggs += [F.count(x).alias(f"n{k}"), F.count(name(c)).alias(f"v{k}")]
            if isinstance(kinds[c], _SIMPLE):
                aggs.append(F.min(x).eqNullSafe(F.max(x)).alias(f"c{k}"))
        row = plain.agg(*aggs).first().asDict()
        for k, c in enumerate(chunk):
            out[c] = ColumnStats(rows, rows - row[f"v{k}"], row[f"n{k}"], row.get(f"c{k}"), False)
    return {c: out[c] for c in kinds}


def stats_table(spark: SparkSession, stats: dict[str, ColumnStats]) -> DataFrame:
    """B3 and D2 of ``table_stats``: (column, missing_rate, is_constant), one row per column."""
    rows = [(c, (x.rows - x.present) / x.rows if x.rows else None, x.constant) for c, x in stats.items()]
    return spark.createDataFrame(rows, "column string, missing_rate double, is_constant boolean")


def row_count(spark: SparkSession, path: str) -> int:
    """B1's row count from the footers."""
    return pushed_down(spark, path).count()
