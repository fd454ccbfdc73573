"""Profiling (B1-B10): shapes, label counts, missing rates, describe, histograms, density, value counts.

All column statistics of a wide table come from one aggregate pass, chunked so
that a few hundred columns stay within the code-generation limits; only the
one-row result is unpivoted, never the input rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.numeric import nan_to_null
from riskflow.settings import DEFAULT, Settings

_FLOATS = (T.DoubleType, T.FloatType)


def _is_missing(df: DataFrame, c: str) -> Column:
    e = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, _FLOATS):
        e = e | F.isnan(F.col(c))
    return e


def _unpivot_one_row(row_df: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    return row_df.unpivot([], names, key, value)


def wide_stat(df: DataFrame, stat, key: str = "column", value: str = "value", s: Settings = DEFAULT) -> DataFrame:
    """``stat(df, c) -> Column`` for every column in one pass per chunk of ``s.agg_chunk`` columns,
    returned long as (key, value). Each chunk is one aggregate row, unpivoted."""
    cols = df.columns
    parts = []
    for i in range(0, len(cols), s.agg_chunk):
        chunk = cols[i: i + s.agg_chunk]
        row = df.agg(*[stat(df, c).cast("double").alias(c) for c in chunk])
        parts.append(_unpivot_one_row(row, chunk, key, value))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raw_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """B1: rows, columns and the column list of each table."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_cols"),
            F.lit(", ".join(df.columns)).alias("columns"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def target_distribution(df: DataFrame, target: str = DEFAULT.target) -> DataFrame:
    """B2: count per label, descending."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), target)


def missing_rate(df: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Share of NULL/NaN per column, descending (column name breaks ties)."""
    rates = wide_stat(df, lambda d, c: F.avg(_is_missing(d, c).cast("double")), "column", "missing_rate", s)
    return rates.orderBy(F.desc("missing_rate"), "column")


def missing_top(df: DataFrame, n: int = 20, s: Settings = DEFAULT) -> DataFrame:
    """The first ``n`` rows of B3."""
    return missing_rate(df, s).limit(n)


# Fixed values (reference): the columns of the description.
DESCRIBE_COLUMNS = ["TransactionAmt", "TransactionDT", "card1", "addr1"]


def describe(df: DataFrame, cols: list[str] = DESCRIBE_COLUMNS, s: Settings = DEFAULT) -> DataFrame:
    """Count, mean, std (ddof 1), min, quartiles (linear interpolation), max of the columns present.

    NaN counts as missing, as in pandas. One aggregate pass for all columns; its single row becomes one row per
    column with ``inline``. The quartiles are exact (``quantiles``)."""
    from riskflow.operators.quantiles import exact_quantiles

    present = [c for c in cols if c in df.columns]
    quartiles = exact_quantiles(df, present, [0.25, 0.5, 0.75], s)
    aggs, rows = [], []
    for i, c in enumerate(present):
        x = nan_to_null(F.col(c).cast("double"))
        q = F.max(F.array(*[F.lit(v).cast("double") for v in quartiles[c]]))
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), q.alias(f"q{i}"), F.max(x).alias(f"hi{i}")]
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"), F.col(f"q{i}")[0].alias("p25"),
            F.col(f"q{i}")[1].alias("p50"), F.col(f"q{i}")[2].alias("p75"), F.col(f"hi{i}").alias("max")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _range(df: DataFrame, x: Column) -> tuple[float | None, float | None, int, float | None]:
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"), F.stddev_samp(x).alias("sd")).first()
    return r["lo"], r["hi"], r["n"], r["sd"]


def _hist(df: DataFrame, x: Column, bins: int, rng: tuple | None = None) -> DataFrame:
    lo, hi, _, _ = _range(df, x) if rng is None else rng
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (hi - lo) / bins
    if width == 0:
        b = F.lit(0)
    else:
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    d = df.where(x.isNotNull()).select(b.cast("int").alias("bin"))
    return d.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        "n",
    )


def hist_linear(df: DataFrame, col: str = "TransactionDT", bins: int = DEFAULT.hist_bins) -> DataFrame:
    """Equal-width bins between min and max; the max falls in the last bin."""
    return _hist(df, nan_to_null(F.col(col).cast("double")), bins)


def hist_log(df: DataFrame, col: str = "TransactionAmt", bins: int = DEFAULT.hist_bins) -> DataFrame:
    """Equal-width bins of log10(x) over x > 0 (edges reported in log10 units)."""
    x = nan_to_null(F.col(col).cast("double"))
    return _hist(df.where(x > 0), F.log10(x), bins)


def kde_binned(df: DataFrame, col: str = "TransactionDT", bins: int = DEFAULT.hist_bins,
               grid: int = DEFAULT.kde_grid, log: bool = False) -> DataFrame:
    """B8 from the histogram: Gaussian density on ``grid`` points of the ``bins`` bin centres, Scott bandwidth std * n^(-1/5).

    Every bin is spread over the grid with a generator (bins x grid rows at most), then summed per point.
    """
    x = nan_to_null(F.col(col).cast("double"))
    if log:
        df, x = df.where(x > 0), F.log10(x)
    rng = _range(df, x)
    lo, hi, n, sd = rng
    h = None if (sd is None or n == 0) else sd * n ** (-0.2)
    hist = _hist(df, x, bins, rng)
    step = (hi - lo) / (grid - 1) if lo is not None else 0.0
    g = hist.select(
        ((F.col("lo") + F.col("hi")) / 2).alias("mid"), "n",
        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("grid_i"),
    ).withColumn("x", F.lit(lo) + F.col("grid_i") * F.lit(step))
    if not h:
        return g.groupBy("grid_i", "x").agg(F.lit(None).cast("double").alias("density"))
    z = (F.col("x") - F.col("mid")) / F.lit(h)
    kern = F.col("n") * F.exp(F.lit(-0.5) * z * z)
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    return g.groupBy("grid_i", "x").agg((F.sum(kern) * F.lit(norm)).alias("density"))


#: A row adds nothing a double could hold beside its own peak from this many bandwidths on: exp(-0.5 * 9^2) < 2^-53.
KDE_REACH = 9.0


def kde_curve(df: DataFrame, col: str = "TransactionDT", grid: int = DEFAULT.kde_grid, log: bool = False) -> DataFrame:
    """Gaussian density of the rows themselves (log10 of the positive ones with ``log``) on ``grid`` points from the least
    to the greatest value, Scott bandwidth std * n^(-1/5), as (grid_i, x, density).

    Equal values are counted first. Each value then adds to the grid points within ``KDE_REACH`` bandwidths, and the sums by
    point are combined in the tasks, so a shuffle carries at most ``grid`` rows a task. Less than two distinct values have no
    density (NULL, on one point); no value at all gives no point.
    """
    x = nan_to_null(F.col(col).cast("double"))
    if log:
        df, x = df.where(x > 0), F.log10(x)
    lo, hi, n, sd = _range(df, x)
    if lo is None or not sd:
        points = [] if lo is None else [(0, float(lo), None)]
        return df.sparkSession.createDataFrame(points, "grid_i int, x double, density double")
    h, step = sd * n ** (-0.2), (hi - lo) / (grid - 1)
    d = df.select(x.alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    first = F.greatest(F.ceil((F.col("v") - KDE_REACH * h - lo) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("v") + KDE_REACH * h - lo) / step), F.lit(grid - 1)).cast("int")
    # a bandwidth far below the step may leave a value between two points
    near = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    d = d.select("v", "n", F.explode(near).alias("grid_i"))
    z = (F.lit(lo) + F.col("grid_i") * F.lit(step) - F.col("v")) / F.lit(h)
    sums = d.groupBy("grid_i").agg(F.sum(F.col("n") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    points = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("grid_i"))
    return points.join(sums, "grid_i", "left").select(
        "grid_i", (F.lit(lo) + F.col("grid_i") * F.lit(step)).alias("x"),
        (F.coalesce("s", F.lit(0.0)) * F.lit(norm)).alias("density"))


def value_counts(df: DataFrame, col: str, top: int | None = None, section: str | None = None) -> DataFrame:
    """Counts per value, descending, value ascending on ties; NULL is not counted (pandas)."""
    out = (
        df.where(F.col(col).isNotNull())
        .groupBy(col).agg(F.count(F.lit(1)).alias("count"))
        .select(F.lit(section or col).alias("section"), F.col(col).cast("string").alias("value"), "count")
        .orderBy(F.desc("count"), "value")
    )
    return out.limit(top) if top else out


def device_value_counts(df: DataFrame, top: int = 20) -> DataFrame:
    """Counts of DeviceType_norm and the top 20 DeviceInfo_brand values."""
    return value_counts(df, "DeviceType_norm").unionByName(value_counts(df, "DeviceInfo_brand", top))


def email_value_counts(df: DataFrame, top: int = 20) -> DataFrame:
    """Top 20 providers on both sides, counts of the same-domain and same-provider flags."""
    parts = [
        value_counts(df, "P_emaildomain_provider", top),
        value_counts(df, "R_emaildomain_provider", top),
        value_counts(df, "email_same_domain"),
        value_counts(df, "email_same_provider"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
