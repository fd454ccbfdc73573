"""Scalar feature steps (E1-E9) applied to a table: time, device, e-mail and cross features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions import numeric as N
from riskflow.functions import text as X


def add_time_features(df: DataFrame, dt: str = "TransactionDT") -> DataFrame:
    """E1 + E2: DT_day, DT_week, DT_hour, DT_day_part; input passes through when ``dt`` is absent."""
    if dt not in df.columns:
        return df
    parts = N.time_features(dt)
    out = df.select("*", *[e.alias(n) for n, e in parts.items()])
    return out.withColumn("DT_day_part", N.day_part("DT_hour"))


def add_device_features(df: DataFrame) -> DataFrame:
    """E3 + E4: DeviceType_norm, DeviceInfo_brand ('unknown' when the source column is absent)."""
    t = X.device_type_norm("DeviceType") if "DeviceType" in df.columns else F.lit("unknown")
    b = X.device_brand("DeviceInfo") if "DeviceInfo" in df.columns else F.lit("unknown")
    return df.select("*", t.alias("DeviceType_norm"), b.alias("DeviceInfo_brand"))


def add_email_features(df: DataFrame) -> DataFrame:
    """Normalised domains, providers, same-domain / same-provider flags, common-provider flags."""
    cols = []
    for c in ["P_emaildomain", "R_emaildomain"]:
        norm = X.email_norm(c) if c in df.columns else F.lit("unknown")
        cols += [norm.alias(f"{c}_norm")]
    out = df.select("*", *cols)
    out = out.select(
        "*",
        X.email_provider("P_emaildomain_norm").alias("P_emaildomain_provider"),
        X.email_provider("R_emaildomain_norm").alias("R_emaildomain_provider"),
    )
    return out.select(
        "*",
        (F.col("P_emaildomain_norm") == F.col("R_emaildomain_norm")).cast("int").alias("email_same_domain"),
        (F.col("P_emaildomain_provider") == F.col("R_emaildomain_provider")).cast("int").alias("email_same_provider"),
        X.email_is_common("P_emaildomain_provider").alias("P_email_is_common"),
        X.email_is_common("R_emaildomain_provider").alias("R_email_is_common"),
    )


def _kind(df: DataFrame, c: str) -> str:
    t = df.schema[c].dataType
    if isinstance(t, T.StringType):
        return "string"
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    return "float"


def cross_col(df: DataFrame, a: str, b: str) -> F.Column:
    """``str(a) + '_' + str(b)`` with pandas' text of each cell."""
    return F.concat(N.py_str(a, _kind(df, a)), F.lit("_"), N.py_str(b, _kind(df, b)))


# Fixed values (reference): the three crossed pairs and their names.
CROSS_PAIRS = [("card1", "addr1", "card1_addr1"), ("ProductCD", "card4", "ProductCD_card4"),
               ("DeviceType_norm", "ProductCD", "DeviceType_ProductCD")]


def add_cross_features(df: DataFrame, pairs=CROSS_PAIRS) -> DataFrame:
    """Crossed string columns, skipped when a source column is absent."""
    cols = [cross_col(df, a, b).alias(n) for a, b, n in pairs if a in df.columns and b in df.columns]
    return df.select("*", *cols)
