"""Stand-in inputs in the reference's schemas, derived from the driver's ``events`` table.

The reference's raw tables (transactions, identity records) are not shipped, so
``tx`` and ``identity`` are built row-for-row from ``events`` by plain column
expressions: they only give rows in the expected schema and do none of the
operators' work. ``scores`` and ``phi`` give deterministic score / contribution
tables so metric operators can be checked without a trained model.
The DuckDB text of the same tables lives in ``riskflow.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions.hashing import hash32
from riskflow.sources.tables import read_table

# Fixed values (fixture): category lists picked by position.
PRODUCTS = ["W", "C", "R", "H", "S"]
CARD_NETWORKS = ["visa", "mastercard", "amex", "discover"]
DOMAINS = ["gmail.com", "yahoo.com", "Hotmail.com ", "qq.com", "vip.163.com", "sina.com.cn", "cs.mit.edu",
           "irs.gov", "live.com.mx", "anonymous.com", None, None]
DEVICE_TYPES = ["mobile", "desktop", "Mobile Phone", "tablet"]
DEVICE_INFOS = ["SM-G960F Build/R16NW", "iOS Device", "Windows", "MacOS", "Trident/7.0", "rv:11.0", "Moto G (5)",
                "HUAWEI P20", "iPad", "Linux x86", "Android 8.0", "/odd", " "]
SCORE_MODELS = ["m1", "m2", "m3"]
PHI_FEATURES = 50


def _pick(values: list, idx: Column) -> Column:
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(arr, idx.cast("int"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    secs = F.floor(
        F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)") / F.lit(1000000)
    ).cast("bigint")
    return ev.select("event_id", "user_id", "value", k.alias("k"), secs.alias("secs"))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions: TransactionID, isFraud, TransactionDT, TransactionAmt, ProductCD, card1, card4,
    addr1, P_emaildomain, R_emaildomain, V1."""
    e = _events(spark, sf_dir)
    k, eid, uid, v = F.col("k"), F.col("event_id"), F.col("user_id"), F.col("value")
    rate = F.when(v > 100, 40).when(k % 10 == 0, 25).otherwise(3)
    return e.select(
        eid.alias("TransactionID"),
        F.when(hash32(eid, "y") % 100 < rate, 1).otherwise(0).cast("int").alias("isFraud"),
        F.col("secs").alias("TransactionDT"),
        v.alias("TransactionAmt"),
        _pick(PRODUCTS, k % 5).alias("ProductCD"),
        uid.alias("card1"),
        _pick(CARD_NETWORKS, uid % 4).alias("card4"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(k.cast("double")).cast("double").alias("addr1"),
        _pick(DOMAINS, uid % 12).alias("P_emaildomain"),
        _pick(DOMAINS, F.floor((eid % 36) / 3)).alias("R_emaildomain"),
        F.when(eid % 7 == 0, F.lit(None)).otherwise(v * 2).cast("double").alias("V1"),
    )


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity records for every fourth transaction: TransactionID, DeviceType, DeviceInfo, id_sparse, id_const."""
    ev = read_table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    return ev.where(eid % 4 == 0).select(
        eid.alias("TransactionID"),
        _pick(DEVICE_TYPES, uid % 4).alias("DeviceType"),
        _pick(DEVICE_INFOS, eid % 13).alias("DeviceInfo"),
        F.when(eid % 200 == 0, F.lit(1.0)).cast("double").alias("id_sparse"),
        F.lit(1).cast("int").alias("id_const"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long score table (TransactionID, model, y, p): three deterministic 'models' with many tied scores."""
    t = tx(spark, sf_dir).select("TransactionID", F.col("isFraud").alias("y"))
    t = t.withColumn("model", F.explode(F.array(*[F.lit(m) for m in SCORE_MODELS])))
    tid, m, y = F.col("TransactionID"), F.col("model"), F.col("y")
    p = (hash32(tid, m) % 600 + F.lit(350) * y * (hash32(tid, F.concat(F.lit("s"), m)) % 2)).cast("double") / 1000
    return t.select("TransactionID", "model", "y", p.alias("p"))


def phi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contribution table (TransactionID, y, feature, value, phi) for every transaction and 50 features."""
    t = tx(spark, sf_dir).select("TransactionID", F.col("isFraud").alias("y"))
    t = t.withColumn("fidx", F.explode(F.sequence(F.lit(0), F.lit(PHI_FEATURES - 1))))
    key = F.col("TransactionID") * 100 + F.col("fidx")
    return t.select(
        "TransactionID",
        "y",
        F.format_string("f%02d", F.col("fidx")).alias("feature"),
        (hash32(key, "val") % 97).cast("double").alias("value"),
        ((hash32(key, "phi") % 2001 - 1000).cast("double") / 1000).alias("phi"),
    )
