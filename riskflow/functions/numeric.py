"""Numeric column expressions: time parts, day part, amount transforms, risk level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x: Column | str) -> Column:
    """NaN is pandas' missing marker; Spark counts it as a value, so turn it into NULL."""
    x = _c(x)
    return F.when(~F.isnan(x), x)


def time_features(dt: Column | str) -> dict[str, Column]:
    """DT_day = dt // 86400, DT_week = DT_day // 7, DT_hour = (dt // 3600) % 24 (floor division)."""
    dt = _c(dt)
    day = F.floor(dt / F.lit(86400)).cast("int")
    return {
        "DT_day": day,
        "DT_week": F.floor(day / F.lit(7)).cast("int"),
        "DT_hour": F.pmod(F.floor(dt / F.lit(3600)), F.lit(24)).cast("int"),
    }


# Fixed values (reference): right-closed hour bins (-1,6], (6,12], (12,18], (18,24] and their labels.
DAY_PART_BINS = [(6, "night"), (12, "morning"), (18, "afternoon"), (24, "evening")]


def day_part(hour: Column | str) -> Column:
    """pd.cut of the hour into the four bins above; outside the bins pandas gives NaN -> 'nan' after astype(str)."""
    h = _c(hour)
    e = F.when(h.isNull() | (h <= -1), F.lit("nan"))
    for hi, label in DAY_PART_BINS:
        e = e.when(h <= hi, F.lit(label))
    return e.otherwise(F.lit("nan"))


def amount_log(x: Column | str) -> Column:
    """log1p(max(x, 0)); NULL stays NULL (greatest() would skip it)."""
    x = _c(x)
    return F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0))))


def amount_ratio(x: Column | str, avg: Column | str, global_mean: Column | float) -> Column:
    """x / avg, an average of 0 replaced by the global mean; a zero denominator gives NULL."""
    x, avg = _c(x), _c(avg)
    g = global_mean if isinstance(global_mean, Column) else F.lit(float(global_mean))
    denom = F.when(avg == 0, g).otherwise(avg)
    return F.try_divide(x, denom)


# Fixed values (reference): risk bands of the scoring app, upper bounds exclusive, and their labels.
RISK_BANDS = [(0.01, "极低风险"), (0.05, "较低风险"), (0.20, "中等风险")]
RISK_TOP = "高风险"


def risk_level(p: Column | str) -> Column:
    p = _c(p)
    e = None
    for bound, label in RISK_BANDS:
        e = F.when(p < bound, F.lit(label)) if e is None else e.when(p < bound, F.lit(label))
    return e.otherwise(F.lit(RISK_TOP))


def py_str(x: Column | str, kind: str) -> Column:
    """Python ``str()`` of a pandas cell: ints as digits, floats with '.0', NaN/NULL as 'nan'.

    Spark prints doubles >= 1e7 as ``1.2E7``; Python prints ``12000000.0``. Whole doubles
    go through ``bigint``; other doubles in [1e-4, 1e16) through a plain decimal string.
    """
    x = _c(x)
    if kind == "string":
        return F.coalesce(x, F.lit("nan"))
    if kind == "int":
        return F.coalesce(x.cast("bigint").cast("string"), F.lit("nan"))
    ax = F.abs(x)
    whole = (x == F.floor(x)) & (ax < F.lit(1e16))
    plain = F.regexp_replace(F.regexp_replace(x.cast("decimal(38,18)").cast("string"), "0+$", ""), "\\.$", ".0")
    s = (
        F.when(x.isNull() | F.isnan(x), F.lit("nan"))
        .when(whole, F.concat(x.cast("bigint").cast("string"), F.lit(".0")))
        .when((ax >= F.lit(1e-4)) & (ax < F.lit(1e16)), plain)
        .otherwise(x.cast("string"))
    )
    return s
