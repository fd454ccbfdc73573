"""Queries for lookups, encoders, assembly / selection and splits (C2, C3, G, H0, H1, H5-H7, I)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskflow.functions.hashing import hash32_sql
from riskflow.functions.numeric import nan_to_null
from riskflow.operators import behavior as B
from riskflow.operators import encode as E
from riskflow.operators import select as S
from riskflow.operators import split as SP
from riskflow.plans import oracle as O
from riskflow.plans.catalog import query
from riskflow.plans.pipeline import merged, stages
from riskflow.plans.queries_base import _m_brand_sql, _m_email_sql, _m_type_sql, _scratch, _sql_list
from riskflow.settings import DEFAULT
from riskflow.sources import fixtures as fx
from riskflow.sources import layout as L
from riskflow.sources import tables as T

w = O.with_ctes

# text columns of the behaviour stage (all get a frequency code; all but the card/address key pass the
# 2..100 distinct-value gate on the fixture and get a target-mean code)
STR_COLS = ["ProductCD", "card4", "P_emaildomain", "R_emaildomain", "DeviceType", "DeviceInfo", "DT_day_part",
            "DeviceType_norm", "DeviceInfo_brand", "P_emaildomain_norm", "R_emaildomain_norm",
            "P_emaildomain_provider", "R_emaildomain_provider", "card1_addr1_key"]
TE_COLS = [c for c in STR_COLS if c != "card1_addr1_key"]
BASE_NUM = ["TransactionID", "TransactionDT", "TransactionAmt", "card1", "addr1", "V1", "DT_day", "DT_week", "DT_hour",
            "email_same_domain", "email_same_provider", "P_email_is_common", "R_email_is_common", "card1_txn_cnt",
            "card1_amt_mean", "card1_amt_std", "amt_div_card1_mean", "card1_recent3_amt_mean", "card1_recent3_amt_std",
            "time_since_last_tx_card1", "time_since_last_tx_card1_hours", "time_since_first_tx_card1",
            "card1_addr1_txn_cnt", "card1_addr1_amt_mean", "fr_card1_addr1", "fr_card1_Pemailprov"]
FREQ_COLS = [f"{c}__freq" for c in STR_COLS]
TE_OUT = [f"{c}__te" for c in TE_COLS]
NUM_FEATS = BASE_NUM + FREQ_COLS + TE_OUT

_freq = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN CAST(count({c}) OVER (PARTITION BY {c}) AS DOUBLE) / "
                  f"(SELECT count(*) FROM behavior) END AS {c}__freq" for c in STR_COLS)
O.cte("freq", ["behavior"], f"SELECT *, {_freq} FROM behavior")
_te = ", ".join(f"coalesce(avg(CAST(isFraud AS DOUBLE)) OVER (PARTITION BY {c}), (SELECT avg(CAST(isFraud AS DOUBLE)) "
                f"FROM freq)) AS {c}__te" for c in TE_COLS)
O.cte("encoded", ["freq"], f"SELECT *, {_te} FROM freq")


_H42 = hash32_sql("TransactionID", "'42'")
O.cte("ranked", ["tx"], f"""
SELECT TransactionID, isFraud, row_number() OVER (PARTITION BY isFraud ORDER BY {_H42}, TransactionID) AS rk,
       count(*) OVER (PARTITION BY isFraud) AS n_class
FROM tx""")
O.cte("train_ids", ["ranked"], "SELECT TransactionID FROM ranked WHERE rk > floor(0.2 * n_class + 0.5)")


@query("freq_encode", w(f"SELECT TransactionID, {_sql_list(FREQ_COLS)} FROM freq", "freq"))
def freq_encode(spark, sf):
    """G1: count / rows of every value of every text column (one exploded aggregate, joined back)."""
    return stages(spark, sf).freq.select("TransactionID", *FREQ_COLS)


@query("target_encode", w(f"SELECT TransactionID, {_sql_list(TE_OUT)} FROM encoded", "encoded"))
def target_encode(spark, sf):
    """Label mean per value of the gated text columns, global mean for unseen values."""
    return stages(spark, sf).crossed.select("TransactionID", *TE_OUT)


@query("cardinality_gate", w(" UNION ALL ".join(
    f"SELECT '{c}' AS col, count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) BETWEEN 2 AND {DEFAULT.max_te_card} "
    f"AS gated FROM behavior" for c in STR_COLS), "behavior"))
def cardinality_gate(spark, sf):
    """Exact distinct count of each text column and whether it is in [2, 100]."""
    b = stages(spark, sf, until="behavior").behavior
    stats = E.category_stats(b, STR_COLS)
    return E.cardinality_gate(stats, STR_COLS)


O.cte("app_norm", ["merged"], f"""
SELECT TransactionID, TransactionAmt, card1, addr1, {_m_type_sql('DeviceType')} AS DeviceType_norm,
       {_m_brand_sql('DeviceInfo')} AS DeviceInfo_brand, {_m_email_sql('P_emaildomain')} AS P_emaildomain_provider
FROM merged""")
O.cte("app_codes", ["app_norm"], " UNION ALL ".join(f"""
SELECT '{c}' AS col, key, CAST(row_number() OVER (ORDER BY first_id) - 1 AS DOUBLE) AS value
FROM (SELECT {c} AS key, min(TransactionID) AS first_id FROM app_norm GROUP BY {c}) g""" for c in E.MANUAL_CATS))


@query("label_encode", w("SELECT * FROM app_codes", "app_codes"))
def label_encode(spark, sf):
    """Codes 0.. in order of first appearance of the app's three normalised text fields."""
    m = merged(spark, sf)
    b = E._manual_base(m)
    out = None
    for c in E.MANUAL_CATS:
        st = E.label_codes(b, c)
        out = st if out is None else out.unionByName(st)
    return out


def _le_sql(c: str) -> str:
    return (f"CAST(coalesce((SELECT value FROM app_codes a WHERE a.col = '{c}' AND a.key = n.{c}), "
            f"coalesce((SELECT value FROM app_codes a WHERE a.col = '{c}' AND a.key = '__MISSING__'), 0.0)) AS DOUBLE)")


_MANUAL_SQL = w(f"""
SELECT n.TransactionID,
       coalesce(n.TransactionAmt, 0.0) AS TransactionAmt,
       coalesce(CASE WHEN n.TransactionAmt IS NOT NULL THEN ln(1 + greatest(n.TransactionAmt, 0)) END, 0.0) AS TransactionAmt_log,
       coalesce(CAST(n.card1 AS DOUBLE), 0.0) AS card1,
       coalesce(n.addr1, 0.0) AS addr1,
       coalesce(coalesce(m.card1_avg_amt, g.gm), 0.0) AS card1_avg_amt,
       coalesce(n.TransactionAmt / nullif(CASE WHEN coalesce(m.card1_avg_amt, g.gm) = 0 THEN g.gm
                                      ELSE coalesce(m.card1_avg_amt, g.gm) END, 0), 0.0) AS amt_to_card1_ratio,
       {_le_sql('DeviceType_norm')} AS DeviceType_norm_le,
       {_le_sql('DeviceInfo_brand')} AS DeviceInfo_brand_le,
       {_le_sql('P_emaildomain_provider')} AS P_emaildomain_provider_le
FROM app_norm n
LEFT JOIN (SELECT card1, avg(TransactionAmt) AS card1_avg_amt FROM app_norm GROUP BY card1
           HAVING avg(TransactionAmt) IS NOT NULL) m ON CAST(n.card1 AS DOUBLE) = CAST(m.card1 AS DOUBLE),
     (SELECT coalesce(avg(TransactionAmt), 0.0) AS gm FROM app_norm) g""", "app_norm", "app_codes")


@query("manual_features", _MANUAL_SQL)
def manual_features(spark, sf):
    """The scoring app's nine features, fitted (card means, codes) and applied on the merged table."""
    m = merged(spark, sf)
    model = E.manual_features_fit(m)
    return model.transform(m, keep=["TransactionID"])


@query("map_lookup", w("""
SELECT t.TransactionID, t.ProductCD, coalesce(f.value, -1.0) AS ProductCD_freq
FROM tx t LEFT JOIN (SELECT ProductCD AS key, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM tx) AS value
                     FROM tx WHERE ProductCD IS NOT NULL GROUP BY ProductCD) f ON t.ProductCD = f.key""", "tx"))
def map_lookup(spark, sf):
    """Dictionary lookup as a left join to a (key, value) state, default -1 for unseen keys."""
    t = fx.tx(spark, sf)
    st = E.freq_state(t, ["ProductCD"])
    return E.map_lookup(t, st, "ProductCD", "ProductCD_freq", default=-1.0).select(
        "TransactionID", "ProductCD", "ProductCD_freq")


@query("context_join", w("""
SELECT s.TransactionID, s.model, s.y, s.p, b.TransactionAmt, b.DT_week, b.DeviceType_norm, b.card1
FROM scores s JOIN behavior b ON s.TransactionID = b.TransactionID""", "scores", "behavior"))
def context_join(spark, sf):
    """Business columns attached to scored rows by row key (not by row position)."""
    b = stages(spark, sf, until="behavior").behavior.select("TransactionID", "TransactionAmt", "DT_week", "DeviceType_norm", "card1")
    return fx.scores(spark, sf).join(b, "TransactionID", "inner")


@query("context_join_stored", w("""
SELECT s.TransactionID, s.model, s.y, s.p, b.TransactionAmt, b.DT_week, b.DeviceType_norm, b.card1
FROM scores s JOIN behavior b ON s.TransactionID = b.TransactionID""", "scores", "behavior"))
def context_join_stored(spark, sf):
    """C3 on stored stages: scores and business columns bucketed by TransactionID, joined without a shuffle."""
    b = stages(spark, sf, until="behavior").behavior.select("TransactionID", "TransactionAmt", "DT_week", "DeviceType_norm", "card1")
    return L.store_bucketed(fx.scores(spark, sf), name="scores").join(L.store_bucketed(b, name="context"), "TransactionID", "inner")


@query("assemble")
def assemble(spark, sf):
    """H0: all numeric features of the encoded table in one vector column, id and label beside it."""
    return S.assemble(stages(spark, sf).crossed)


@query("matrix_rows", w(" UNION ALL ".join(
    f"SELECT TransactionID, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM encoded" for c in NUM_FEATS), "encoded"))
def matrix_rows(spark, sf):
    """H0 + A5: the assembled matrix, stored and read back, as (id, feature, value) rows by the stored names; NaN is NULL."""
    path = _scratch(spark, "matrix-rows")
    m = T.sink_matrix(S.assemble(stages(spark, sf).crossed), path)
    names = [r["feature"] for r in spark.read.parquet(path + "_names").orderBy("idx").collect()]  # one row per column
    d = m.select("TransactionID", F.posexplode(vector_to_array("features")).alias("i", "value"))
    return d.select("TransactionID", F.get(F.array(*[F.lit(c) for c in names]), F.col("i")).alias("feature"),
                    nan_to_null(F.col("value")).alias("value"))


@query("fraud_rates_train_only", w("""
SELECT e.TransactionID, CASE WHEN e.card1 IS NOT NULL AND e.addr1 IS NOT NULL THEN a.r END AS fr_card1_addr1, p.r AS fr_card1_Pemailprov
FROM email e
LEFT JOIN (SELECT card1, addr1, avg(CAST(isFraud AS DOUBLE)) AS r FROM email JOIN train_ids USING (TransactionID) GROUP BY card1, addr1) a
  ON a.card1 = e.card1 AND a.addr1 = e.addr1
LEFT JOIN (SELECT card1, P_emaildomain_provider AS pr, avg(CAST(isFraud AS DOUBLE)) AS r FROM email JOIN train_ids USING (TransactionID)
           GROUP BY ALL) p ON p.card1 = e.card1 AND p.pr = e.P_emaildomain_provider""", "email", "train_ids"))
def fraud_rates_train_only(spark, sf):
    """F8 + F9 fitted on the training rows of the split and applied to all rows."""
    e = stages(spark, sf, until="email").email
    split = SP.stratified_split(e.select("TransactionID", "isFraud")).where(~F.col("is_valid"))
    train = e.join(split.select("TransactionID"), "TransactionID", "left_semi")
    out = B.behavior_features(e, user=False, interval=False, fit_df=train)
    return out.select("TransactionID", "fr_card1_addr1", "fr_card1_Pemailprov")


@query("variance_filter", w(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_pop(CAST({c} AS DOUBLE)) AS variance, "
    f"coalesce(var_pop(CAST({c} AS DOUBLE)) > {DEFAULT.variance_threshold}, false) AS kept FROM encoded"
    for c in NUM_FEATS), "encoded"))
def variance_filter(spark, sf):
    """H1: population variance of every numeric feature and the keep flag (> 1e-5)."""
    return S.variance_table(stages(spark, sf).crossed)


def _corr_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    yc = f"CASE WHEN {c} IS NOT NULL THEN CAST(isFraud AS DOUBLE) END"
    return (f"SELECT '{c}' AS feature, covar_pop({x}, {yc}) / nullif(stddev_pop({x}) * stddev_pop({yc}), 0) AS corr "
            f"FROM encoded")


O.cte("corr", ["encoded"], " UNION ALL ".join(_corr_sql(c) for c in NUM_FEATS))


@query("leakage_corr", w("SELECT * FROM corr", "corr"))
def leakage_corr(spark, sf):
    """H5: Pearson correlation of every numeric feature with the label."""
    return S.leakage_corr(stages(spark, sf).crossed)


@query("leakage_top30", w("""
SELECT side, CAST(pos AS INTEGER) AS pos, feature, corr FROM (
  SELECT 'top_pos' AS side, * FROM (SELECT row_number() OVER (ORDER BY round(corr, 10) DESC NULLS LAST, feature) AS pos, feature, corr,
                                           count(*) OVER () AS n_all FROM corr) r WHERE pos <= 30
  UNION ALL
  SELECT 'top_neg', * FROM (SELECT row_number() OVER (ORDER BY round(corr, 10) DESC NULLS LAST, feature) AS pos, feature, corr,
                                   count(*) OVER () AS n_all FROM corr) r WHERE pos > n_all - 30)""", "corr"))
def leakage_top30(spark, sf):
    """H6: 30 most positive and 30 last (most negative, then NULL) correlations."""
    return S.leakage_top(S.leakage_corr(stages(spark, sf).crossed), 30)


@query("leakage_suspicious", w("SELECT * FROM corr WHERE abs(corr) > 0.9", "corr"))
def leakage_suspicious(spark, sf):
    """H7: features with abs(corr) > 0.9."""
    return S.leakage_suspicious(S.leakage_corr(stages(spark, sf).crossed))


# ---- I: splits, samples, weights ----------------------------------------------------------------

@query("stratified_split", w("SELECT TransactionID, isFraud, rk <= floor(0.2 * n_class + 0.5) AS is_valid FROM ranked",
                             "ranked"))
def stratified_split(spark, sf):
    """80/20 split with class shares kept, a pure function of (id, seed)."""
    return SP.stratified_split(fx.tx(spark, sf).select("TransactionID", "isFraud"))


@query("split_index", w("SELECT TransactionID FROM ranked WHERE rk <= floor(0.2 * n_class + 0.5)", "ranked"))
def split_index(spark, sf):
    """The validation ids rebuilt from the seed."""
    return SP.split_index(fx.tx(spark, sf))


@query("stratified_kfold", w("SELECT TransactionID, isFraud, CAST((rk - 1) % 5 + 1 AS INTEGER) AS fold FROM ranked",
                             "ranked"))
def stratified_kfold(spark, sf):
    """Five folds dealt along the hash order inside each class."""
    return SP.stratified_kfold(fx.tx(spark, sf).select("TransactionID", "isFraud"))


@query("subsample_n", w(f"""
SELECT TransactionID, isFraud FROM (
  SELECT TransactionID, isFraud, row_number() OVER (ORDER BY {_H42}, TransactionID) AS r FROM tx) t
WHERE r <= {DEFAULT.shap_explain}""", "tx"))
def subsample_n(spark, sf):
    """I4: exactly min(2000, n) rows without replacement (the explanation sample size)."""
    return SP.subsample_n(fx.tx(spark, sf).select("TransactionID", "isFraud"), DEFAULT.shap_explain)


@query("balanced_weight", w("""
SELECT TransactionID, isFraud, CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY isFraud)) AS weight
FROM tx""", "tx"))
def balanced_weight(spark, sf):
    """I5: 'balanced' class weights n / (2 * n_class)."""
    return SP.balanced_weight(fx.tx(spark, sf).select("TransactionID", "isFraud"))


@query("scale_pos_weight", w("""
SELECT TransactionID, isFraud, CASE WHEN isFraud = 1 THEN
       CAST(sum(CASE WHEN isFraud <> 1 THEN 1 ELSE 0 END) OVER () AS DOUBLE)
         / greatest(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) OVER (), 1) ELSE 1.0 END AS weight
FROM tx""", "tx"))
def scale_pos_weight(spark, sf):
    """Positives weigh negatives / max(positives, 1)."""
    out, _ = SP.scale_pos_weight(fx.tx(spark, sf).select("TransactionID", "isFraud"))
    return out


@query("feature_table", w("""
SELECT e.*, CAST(card1 AS VARCHAR) || '_' || coalesce(CAST(addr1 AS VARCHAR), 'nan') AS card1_addr1,
       ProductCD || '_' || card4 AS ProductCD_card4, DeviceType_norm || '_' || ProductCD AS DeviceType_ProductCD
FROM encoded e""", "encoded"))
def feature_table(spark, sf):
    """The whole feature pipeline end to end (merge -> clean -> time / device / e-mail -> per-card behaviour ->
    frequency and target-mean codes -> cross features): every column of the final table."""
    return stages(spark, sf).crossed
