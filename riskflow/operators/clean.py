"""Cleaning (D1-D8): drop sparse and constant columns, fill numbers and strings, project, guard, coerce.

Steps whose output *schema* depends on the data (D1, D2, D3) run one aggregate
pass and collect a single statistics row (bounded by the number of columns),
then continue lazily on the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.numeric import nan_to_null
from riskflow.operators.profile import _FLOATS, missing_rate, wide_stat
from riskflow.operators.quantiles import exact_quantiles
from riskflow.session import stage_path
from riskflow.settings import DEFAULT, Settings
from riskflow.sources.footers import table_stats

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_SIMPLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def column_stats(df: DataFrame, s: Settings = DEFAULT, strategy: str = "median") -> dict[str, dict]:
    """D1 + D2 + D3 statistics of every column, one aggregate pass per chunk of columns (medians: ``quantiles``):
    missing share (NULL or NaN), whether it has at most one distinct non-null value, the fill value
    (exact median or mean) of numeric columns and their NULL count. Returns {column: {stat: value}}
    (bounded by the column count). A stored stage gives all but the fill values from its file footers where they tell."""
    out: dict[str, dict] = {}
    fields = df.schema.fields
    step = max(10, s.agg_chunk // 4)
    medians = {}
    if strategy != "mean":
        medians = {c: v[0] for c, v in exact_quantiles(df, numeric_columns(df), [0.5], s).items()}
        if stage_path(df):
            known = table_stats(df.sparkSession, stage_path(df), spark_written=True, s=s)
            return {f.name: {"missing_rate": 1 - x.present / x.rows if x.rows else None, "nulls": x.nulls, "is_constant": x.constant,
                             "fill": medians.get(f.name), "numeric": isinstance(f.dataType, T.NumericType)}
                    for f, x in ((f, known[f.name]) for f in fields)}
    for i in range(0, len(fields), step):
        chunk = fields[i: i + step]
        aggs = []
        for k, f in enumerate(chunk):
            c, x = f.name, F.col(f.name)
            miss = x.isNull() | F.isnan(x) if isinstance(f.dataType, _FLOATS) else x.isNull()
            aggs.append(F.avg(miss.cast("double")).alias(f"m{k}"))
            aggs.append(F.sum(x.isNull().cast("int")).alias(f"n{k}"))
            if isinstance(f.dataType, _SIMPLE):
                v = _non_nan(df, c)
                aggs.append(F.min(v).eqNullSafe(F.max(v)).alias(f"c{k}"))
            if isinstance(f.dataType, T.NumericType) and strategy == "mean":
                aggs.append(F.avg(_non_nan(df, c).cast("double")).alias(f"f{k}"))
        row = df.agg(*aggs).first().asDict()
        for k, f in enumerate(chunk):
            out[f.name] = {"missing_rate": row[f"m{k}"], "nulls": row[f"n{k}"],
                           "is_constant": row.get(f"c{k}"), "fill": row.get(f"f{k}", medians.get(f.name)),
                           "numeric": isinstance(f.dataType, T.NumericType)}
    return out


def clean_with_stats(df: DataFrame, s: Settings = DEFAULT) -> tuple[DataFrame, list[str], list[str], DataFrame]:
    """D1 -> D2 -> D3 -> D4 from one statistics pass (``column_stats``): the same result as running them one by
    one, because each statistic of a column only depends on that column."""
    st = column_stats(df, s)
    miss = [c for c in df.columns if st[c]["missing_rate"] is not None and st[c]["missing_rate"] > s.missing_threshold]
    rest = [c for c in df.columns if c not in miss]
    const = [c for c in rest if st[c]["is_constant"]]
    d2 = df.drop(*miss, *const)
    rows = [(c, None, st[c]["fill"]) for c in d2.columns if st[c]["numeric"]]
    state = df.sparkSession.createDataFrame(rows, "col string, key string, value double")
    out = d2
    for f in d2.schema.fields:
        c, v = f.name, st[f.name]["fill"]
        if not st[c]["numeric"] or v is None:
            continue
        x = F.col(c)
        if isinstance(f.dataType, _FLOATS):
            out = out.withColumn(c, F.when(x.isNull() | F.isnan(x), F.lit(v)).otherwise(x))
        elif isinstance(f.dataType, _INTEGRAL) and st[c]["nulls"]:
            out = out.withColumn(c, F.coalesce(x.cast("double"), F.lit(v)))
    return categorical_fill(out), miss, const, state


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def high_missing_columns(df: DataFrame, threshold: float = DEFAULT.missing_threshold,
                         s: Settings = DEFAULT) -> DataFrame:
    """D1 report: columns whose missing share is strictly above ``threshold``."""
    return missing_rate(df, s).where(F.col("missing_rate") > F.lit(threshold))


def drop_high_missing(df: DataFrame, threshold: float = DEFAULT.missing_threshold,
                      s: Settings = DEFAULT) -> tuple[DataFrame, list[str]]:
    """Drop the columns of the report (one stats pass, list bounded by the column count)."""
    cols = [r["column"] for r in high_missing_columns(df, threshold, s).collect()]  # <= one row per column
    return df.drop(*cols), cols


def _non_nan(df: DataFrame, c: str):
    x = F.col(c)
    if isinstance(df.schema[c].dataType, _FLOATS):
        return F.when(~F.isnan(x), x)
    return x


def constant_columns(df: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """D2 report: columns with at most one distinct non-null value (all-NULL included), as (column, is_constant).

    ``min <=> max`` over non-null values decides it in one pass, without a distinct count per column.
    """
    simple = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType, T.DateType,
                                         T.TimestampType, T.TimestampNTZType))]
    sub = df.select(*simple)

    def stat(d, c):
        x = _non_nan(d, c)
        return F.min(x).eqNullSafe(F.max(x)).cast("int")

    return wide_stat(sub, stat, "column", "is_constant", s).select(
        "column", (F.col("is_constant") == 1).alias("is_constant")
    )


def drop_constant(df: DataFrame, s: Settings = DEFAULT) -> tuple[DataFrame, list[str]]:
    cols = [r["column"] for r in constant_columns(df, s).where("is_constant").collect()]  # <= one row per column
    return df.drop(*cols), cols


def numeric_fill_values(df: DataFrame, strategy: str = "median", s: Settings = DEFAULT) -> DataFrame:
    """D3 state: (col, key=NULL, value) with the exact median (or mean) of every numeric column."""
    cols = numeric_columns(df)
    if strategy == "mean":
        vals = wide_stat(df.select(*cols), lambda d, c: F.avg(_non_nan(d, c).cast("double")), "col", "value", s)
    else:
        rows = [(c, v[0]) for c, v in exact_quantiles(df, cols, [0.5], s).items()]
        vals = df.sparkSession.createDataFrame(rows, "col string, value double")
    return vals.select("col", F.lit(None).cast("string").alias("key"), "value")


def median_fill(df: DataFrame, strategy: str = "median", state: DataFrame | None = None,
                s: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """D3: fill every numeric column (label and id included) with its median; returns (filled, state).

    An integral column that has NULLs becomes double first, as the pandas column already is.
    """
    if state is None:
        state = numeric_fill_values(df, strategy, s)
    fills = {r["col"]: r["value"] for r in state.collect()}  # one row per numeric column
    nulls = df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in fills]).first().asDict()
    out = df
    for f in df.schema.fields:
        c = f.name
        if c not in fills or fills[c] is None:
            continue
        x = F.col(c)
        if isinstance(f.dataType, _FLOATS):
            out = out.withColumn(c, F.when(x.isNull() | F.isnan(x), F.lit(fills[c])).otherwise(x))
        elif isinstance(f.dataType, _INTEGRAL) and nulls.get(c):
            out = out.withColumn(c, F.coalesce(x.cast("double"), F.lit(fills[c])))
    return out, state


def categorical_fill(df: DataFrame, value: str = "missing") -> DataFrame:
    """NULL strings -> ``value``."""
    cols = string_columns(df)
    return df.na.fill(value, subset=cols) if cols else df


def project_numeric(df: DataFrame, target: str = DEFAULT.target, exclude: list[str] = ()) -> DataFrame:
    """Numeric columns only, target (and ``exclude``) dropped."""
    return df.select(*[c for c in numeric_columns(df) if c != target and c not in exclude])


# Fixed values (reference): business fields shown next to a scored row.
BUSINESS_COLUMNS = ["TransactionID", "TransactionAmt", "DT_week", "DT_day", "DT_hour", "card1", "addr1",
                    "DeviceType_norm", "DeviceInfo_brand", "P_emaildomain_provider", "isFraud"]


def project_business(df: DataFrame, wanted: list[str] = BUSINESS_COLUMNS) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


class MissingColumns(ValueError):
    pass


def schema_guard(df: DataFrame, required: list[str], on_missing: str = "pass", default=None,
                 default_type: str = "string") -> tuple[DataFrame, bool]:
    """Plan-time check of required columns. ``pass``: input unchanged, flag False; ``raise``;
    ``default``: add each absent column as the literal ``default`` (NULL when None)."""
    absent = [c for c in required if c not in df.columns]
    if not absent:
        return df, True
    if on_missing == "raise":
        raise MissingColumns(f"missing columns: {absent}")
    if on_missing == "default":
        out = df
        for c in absent:
            out = out.withColumn(c, F.lit(default).cast(default_type))
        return out, True
    return df, False


def numeric_coerce(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text to double, unparsable text and 'nan' to NULL (``try_cast``; plain cast raises under ANSI)."""
    out = df
    for c in cols:
        if c in df.columns:
            out = out.withColumn(c, nan_to_null(F.col(c).cast("string").try_cast("double")))
    return out
