"""Queries for scans/sinks, profiling, joins, cleaning, scalar and per-card features (A1-A4, B, C1, D, E, F)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskflow.functions import numeric as N
from riskflow.functions import text as X
from riskflow.operators import behavior as B
from riskflow.operators import clean as C
from riskflow.operators import features as FE
from riskflow.operators import profile as P
from riskflow.operators import states as ST
from riskflow.plans import oracle as O
from riskflow.plans.catalog import query
from riskflow.plans.pipeline import merge_identity as merge_identity_op
from riskflow.plans.pipeline import merged, stages
from riskflow.session import cut_lineage, scratch_dir, stage_path
from riskflow.sources import fixtures as fx
from riskflow.sources import footers
from riskflow.sources import layout as L
from riskflow.sources import tables as T
from riskflow.settings import DEFAULT

w = O.with_ctes

TX_COLS = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card4", "addr1",
           "P_emaildomain", "R_emaildomain", "V1"]
ID_COLS = ["TransactionID", "DeviceType", "DeviceInfo", "id_sparse", "id_const"]
MERGED_COLS = TX_COLS + ID_COLS[1:]
DOUBLE_COLS = {"TransactionAmt", "addr1", "V1", "id_sparse"}
FILLED_NUMERIC = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "card1", "addr1", "V1"]
FILLED_STRINGS = ["ProductCD", "card4", "P_emaildomain", "R_emaildomain", "DeviceType", "DeviceInfo"]


def _scratch(spark, name: str) -> str:
    return os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


def _sql_list(cols) -> str:
    return ", ".join(cols)


# ---- A: scans and sinks ------------------------------------------------------------------------


@query("scan_table", w("SELECT * FROM tx", "tx"))
def scan_table(spark, sf):
    """A1: full typed read of the transaction table."""
    return fx.tx(spark, sf)


@query("scan_csv", w("""
SELECT TransactionID, CAST(isFraud AS BIGINT) AS isFraud, TransactionDT, TransactionAmt, ProductCD, CAST(card1 AS BIGINT) AS card1,
       card4, addr1, P_emaildomain, R_emaildomain, V1 FROM tx""", "tx"))
def scan_csv(spark, sf):
    """A1: the transactions as CSV files, read back without a schema: every type inferred from the values."""
    path = _scratch(spark, "csv")
    (fx.tx(spark, sf).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return T.scan_table(spark, path, fmt="csv")


_STATE_COLS = ["ProductCD", "card4", "P_emaildomain", "card1"]
_STATE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS key, count(*) AS n, count(isFraud) AS n_y, "
    f"coalesce(sum(CAST(isFraud AS DOUBLE)), 0.0) AS sum_y, count(TransactionAmt) AS n_v, "
    f"coalesce(sum(TransactionAmt), 0.0) AS sum_v, min(TransactionID) AS first, {ST.VERSION} AS version FROM tx GROUP BY {c}"
    for c in _STATE_COLS)


@query("state_merge", w(_STATE_SQL, "tx"))
def state_merge(spark, sf):
    """A4: value states of two batches of the transactions, stored, loaded and merged into the state of all."""
    t = fx.tx(spark, sf)
    batches = [F.col("TransactionID") % 2 == 0, F.col("TransactionID") % 2 != 0]
    paths = [_scratch(spark, "value-state") for _ in batches]
    for b, path in zip(batches, paths):
        ST.save_value_state(ST.value_state(t.where(b), _STATE_COLS), path)
    return ST.merge_states(*[ST.load_value_state(spark, path) for path in paths])


@query("sink_stage", w("SELECT * FROM merged", "merged"))
def sink_stage(spark, sf):
    """A2: the merged stage written as Parquet and read back."""
    return T.sink_stage(merged(spark, sf), _scratch(spark, "stage"))


O.cte("miss", ["merged"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL {'OR isnan(' + c + ')' if c in DOUBLE_COLS else ''}"
    f" THEN 1.0 ELSE 0.0 END) AS missing_rate FROM merged" for c in MERGED_COLS))

_REPORT_SQL = w("""
SELECT 'target' AS section, CAST(isFraud AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) AS value FROM tx GROUP BY isFraud
UNION ALL
SELECT 'dropped_high_missing', "column", CAST(missing_rate AS VARCHAR) FROM miss WHERE missing_rate > 0.9""", "tx", "miss")


@query("sink_report", _REPORT_SQL)
def sink_report(spark, sf):
    """A3: report sections (label counts, dropped columns) as (section, key, value) rows, written and read back."""
    t = P.target_distribution(fx.tx(spark, sf))
    parts = [T.report("target", t, "isFraud", "count"),
             T.report("dropped_high_missing", C.high_missing_columns(merged(spark, sf)), "column", "missing_rate")]
    return T.sink_report(parts, _scratch(spark, "report"))


_MEDIANS = " UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST(NULL AS VARCHAR) AS key, CAST(median({c}) AS DOUBLE) AS value FROM merged"
    for c in FILLED_NUMERIC)


@query("sink_state", w(_MEDIANS, "merged"))
def sink_state(spark, sf):
    """A4: the fitted median state (col, key, value) written to Parquet and loaded back."""
    path = _scratch(spark, "state")
    T.sink_state(stages(spark, sf, until="filled").medians, path)
    return T.load_state(spark, path)


# ---- B: profiling ------------------------------------------------------------------------------

@query("raw_overview", w(f"""
SELECT 'transaction' AS table_name, count(*) AS n_rows, CAST({len(TX_COLS)} AS INTEGER) AS n_cols,
       '{", ".join(TX_COLS)}' AS columns FROM tx
UNION ALL
SELECT 'identity', count(*), CAST({len(ID_COLS)} AS INTEGER), '{", ".join(ID_COLS)}' FROM identity""", "tx", "identity"))
def raw_overview(spark, sf):
    """B1: rows, columns and column list of both input tables."""
    return P.raw_overview({"transaction": fx.tx(spark, sf), "identity": fx.identity(spark, sf)})


@query("target_distribution", w("SELECT isFraud, count(*) AS count FROM tx GROUP BY isFraud", "tx"))
def target_distribution(spark, sf):
    """B2: rows per label."""
    return P.target_distribution(fx.tx(spark, sf))


@query("missing_rate", w("SELECT * FROM miss", "miss"))
def missing_rate(spark, sf):
    """NULL/NaN share of every column of the merged table."""
    return P.missing_rate(merged(spark, sf))


@query("missing_top20", w('SELECT * FROM miss ORDER BY missing_rate DESC, "column" LIMIT 20', "miss"))
def missing_top20(spark, sf):
    """The 20 columns with the most missing values."""
    return P.missing_top(merged(spark, sf), 20)


_DESC = " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std,
       min(CAST({c} AS DOUBLE)) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,
       quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75,
       max(CAST({c} AS DOUBLE)) AS max FROM merged""" for c in P.DESCRIBE_COLUMNS)


@query("describe", w(_DESC, "merged"))
def describe(spark, sf):
    """Count, mean, std, min, exact quartiles, max of amount, time, card and address."""
    return P.describe(merged(spark, sf))


def _hist_sql(x: str, where: str, bins: int = DEFAULT.hist_bins) -> str:
    return f"""
SELECT CAST(bin AS INTEGER) AS bin, lo + bin * ((hi - lo) / {bins}) AS lo, lo + (bin + 1) * ((hi - lo) / {bins}) AS hi, n
FROM (SELECT least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1}) AS bin, any_value(lo) AS lo, any_value(hi) AS hi,
             count(*) AS n
      FROM (SELECT {x} AS x, min({x}) OVER () AS lo, max({x}) OVER () AS hi FROM merged WHERE {where}) t
      GROUP BY 1) g"""


@query("hist_linear", w(_hist_sql("CAST(TransactionDT AS DOUBLE)", "TransactionDT IS NOT NULL"), "merged"))
def hist_linear(spark, sf):
    """50 equal-width bins of the transaction time."""
    return P.hist_linear(merged(spark, sf))


@query("hist_log", w(_hist_sql("log10(TransactionAmt)", "TransactionAmt > 0"), "merged"))
def hist_log(spark, sf):
    """50 bins of the amount, equal in log10 space."""
    return P.hist_log(merged(spark, sf))


def _kde_sql() -> str:
    grid, bins = DEFAULT.kde_grid, DEFAULT.hist_bins
    return f"""
WITH h AS ({_hist_sql("CAST(TransactionDT AS DOUBLE)", "TransactionDT IS NOT NULL")}),
s AS (SELECT min(CAST(TransactionDT AS DOUBLE)) AS lo, max(CAST(TransactionDT AS DOUBLE)) AS hi, count(TransactionDT) AS n,
             stddev_samp(CAST(TransactionDT AS DOUBLE)) * pow(count(TransactionDT), -0.2) AS bw FROM merged),
pts AS (SELECT h.n AS bn, (h.lo + h.hi) / 2 AS mid, CAST(unnest(range(0, {grid})) AS INTEGER) AS grid_i FROM h),
k AS (SELECT grid_i, s.lo + grid_i * ((s.hi - s.lo) / {grid - 1}) AS x,
             sum(bn * exp(-0.5 * pow(((s.lo + grid_i * ((s.hi - s.lo) / {grid - 1})) - mid) / s.bw, 2))) AS raw
      FROM pts, s GROUP BY grid_i, s.lo, s.hi, s.bw)
SELECT grid_i, x, raw / (s.n * s.bw * sqrt(2 * pi())) AS density,
       raw / (s.n * s.bw * sqrt(2 * pi())) * s.n * ((s.hi - s.lo) / {bins}) AS count_scale
FROM k, s"""


@query("kde_binned", w(_kde_sql(), "merged"))
def kde_binned(spark, sf):
    """B8, light form: Gaussian density of the transaction time on 200 points, from the 50-bin histogram (Scott bandwidth);
    ``count_scale`` is the density in rows per bin, as drawn over the histogram."""
    m = merged(spark, sf)
    k = P.kde_binned(m)
    lo, hi, n, _ = P._range(m, F.col("TransactionDT").cast("double"))
    return k.withColumn("count_scale", F.col("density") * F.lit(n * ((hi - lo) / DEFAULT.hist_bins)))


def _kde_rows_sql(x: str, where: str) -> str:
    grid = DEFAULT.kde_grid
    return f"""
WITH v AS (SELECT {x} AS v FROM merged WHERE {where}),
s AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS bw FROM v),
g AS (SELECT CAST(unnest(range(0, {grid})) AS INTEGER) AS grid_i)
SELECT grid_i, any_value(lo + grid_i * ((hi - lo) / {grid - 1})) AS x,
       sum(exp(-0.5 * pow((lo + grid_i * ((hi - lo) / {grid - 1}) - v) / bw, 2))) / any_value(n * bw * sqrt(2 * pi())) AS density
FROM g, s, v GROUP BY grid_i"""


@query("kde_curve", w(_kde_rows_sql("CAST(TransactionDT AS DOUBLE)", "TransactionDT IS NOT NULL"), "merged"))
def kde_curve(spark, sf):
    """Gaussian density of the transaction times themselves on 200 points (Scott bandwidth)."""
    return P.kde_curve(merged(spark, sf))


@query("kde_log", w(_kde_rows_sql("log10(TransactionAmt)", "TransactionAmt > 0"), "merged"))
def kde_log(spark, sf):
    """B8 on the logarithm of the amounts, as the amount is drawn."""
    return P.kde_curve(merged(spark, sf), "TransactionAmt", log=True)


def _vc_sql(src: str, col: str, top: int | None = None) -> str:
    lim = f" ORDER BY count DESC, value LIMIT {top}" if top else ""
    return (f"(SELECT '{col}' AS section, CAST({col} AS VARCHAR) AS value, count(*) AS count FROM {src} "
            f"WHERE {col} IS NOT NULL GROUP BY {col}{lim})")


@query("device_value_counts", w(_vc_sql("email", "DeviceType_norm") + " UNION ALL " +
                                _vc_sql("email", "DeviceInfo_brand", 20), "email"))
def device_value_counts(spark, sf):
    """Counts of the normalised device type and the 20 most common device brands."""
    return P.device_value_counts(stages(spark, sf, until="email").email)


@query("email_value_counts", w(" UNION ALL ".join([
    _vc_sql("email", "P_emaildomain_provider", 20), _vc_sql("email", "R_emaildomain_provider", 20),
    _vc_sql("email", "email_same_domain"), _vc_sql("email", "email_same_provider")]), "email"))
def email_value_counts(spark, sf):
    """The 20 most common providers of both sides and the counts of the two 'same' flags."""
    return P.email_value_counts(stages(spark, sf, until="email").email)


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_DOUBLES = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}


O_LINEITEM_PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL {'OR isnan(' + c + ')' if c in LINEITEM_DOUBLES else ''} "
    f"THEN 1.0 ELSE 0.0 END) AS missing_rate, (min({c}) IS NOT DISTINCT FROM max({c})) AS is_constant FROM lineitem"
    for c in LINEITEM_COLS)


@query("lineitem_profile", O_LINEITEM_PROFILE)
def lineitem_profile(spark, sf):
    """B3 + D2 on another given table (600k rows at sf0.1): missing share and constancy of every column."""
    li = T.read_table(spark, sf, "lineitem")
    return P.missing_rate(li).join(C.constant_columns(li), "column", "inner")


@query("footer_profile", O_LINEITEM_PROFILE)
def footer_profile(spark, sf):
    """B3 + D2 of ``lineitem`` from its file footers, the columns read that footers cannot answer."""
    return footers.stats_table(spark, footers.table_stats(spark, f"{sf.rstrip('/')}/lineitem.parquet"))


@query("stage_profile", w(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate, "
    f"(min({c}) IS NOT DISTINCT FROM max({c})) AS is_constant FROM merged" for c in MERGED_COLS), "merged"))
def stage_profile(spark, sf):
    """B3 + D2 of the merged stage: stored, then counts and extremes of the numbers from its footers."""
    st = cut_lineage(merged(spark, sf), "profile")
    return footers.stats_table(spark, footers.table_stats(spark, stage_path(st), spark_written=True))


# ---- C1, D: join and cleaning ------------------------------------------------------------------


@query("merge_identity", w("SELECT * FROM merged", "merged"))
def merge_identity(spark, sf):
    """Transactions left-joined with identity records on TransactionID."""
    return merged(spark, sf)


@query("merge_stored", w("SELECT * FROM merged", "merged"))
def merge_stored(spark, sf):
    """C1 on stored stages: both tables bucketed and sorted by TransactionID, joined without a shuffle."""
    return merge_identity_op(L.store_bucketed(fx.tx(spark, sf), name="tx"), L.store_bucketed(fx.identity(spark, sf), name="identity"))


@query("drop_high_missing", w("SELECT * FROM miss WHERE missing_rate > 0.9", "miss"))
def drop_high_missing(spark, sf):
    """The columns whose missing share is above 0.9 (dropped by the pipeline)."""
    return C.high_missing_columns(merged(spark, sf))


_CONST = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (min({c}) IS NOT DISTINCT FROM max({c})) AS is_constant FROM merged"
    for c in MERGED_COLS if c != "id_sparse")


@query("drop_constant", w(_CONST, "merged"))
def drop_constant(spark, sf):
    """For every column left after D1, whether it has at most one distinct non-null value."""
    d1, _ = C.drop_high_missing(merged(spark, sf))
    return C.constant_columns(d1)


@query("median_fill", w(f"SELECT {_sql_list(FILLED_NUMERIC)} FROM filled", "filled"))
def median_fill(spark, sf):
    """D3: numeric columns after the exact-median fill."""
    return stages(spark, sf, until="filled").filled.select(*FILLED_NUMERIC)


@query("mean_fill", w("SELECT TransactionID, coalesce(addr1, (SELECT avg(addr1) FROM merged)) AS addr1, "
                      "coalesce(V1, (SELECT avg(V1) FROM merged)) AS V1 FROM merged", "merged"))
def mean_fill(spark, sf):
    """D3 with strategy='mean' (listed among the reference's planned features)."""
    m = merged(spark, sf).select("TransactionID", "addr1", "V1")
    out, _ = C.median_fill(m, strategy="mean")
    return out


@query("categorical_fill", w(f"SELECT TransactionID, {_sql_list(FILLED_STRINGS)} FROM filled", "filled"))
def categorical_fill(spark, sf):
    """Text columns with NULL replaced by 'missing'."""
    return stages(spark, sf, until="filled").filled.select("TransactionID", *FILLED_STRINGS)


@query("project_numeric", w(f"SELECT {_sql_list([c for c in FILLED_NUMERIC if c != 'isFraud'])} FROM filled", "filled"))
def project_numeric(spark, sf):
    """Numeric columns of the filled table, label dropped."""
    return C.project_numeric(stages(spark, sf, until="filled").filled)


@query("project_business", w(f"SELECT {_sql_list(C.BUSINESS_COLUMNS)} FROM behavior", "behavior"))
def project_business(spark, sf):
    """The business fields shown beside a scored row."""
    return C.project_business(stages(spark, sf, until="behavior").behavior)


@query("schema_guard", w("SELECT *, 'unknown' AS DeviceOS FROM merged", "merged"))
def schema_guard(spark, sf):
    """Required columns checked at plan time; the absent 'DeviceOS' is added with the default 'unknown'."""
    out, _ = C.schema_guard(merged(spark, sf), ["DeviceType", "DeviceOS"], on_missing="default", default="unknown")
    return out


@query("numeric_coerce", w("SELECT TransactionID, TRY_CAST(CAST(addr1 AS VARCHAR) AS DOUBLE) AS addr1, "
                           "TRY_CAST(DeviceInfo AS DOUBLE) AS DeviceInfo FROM merged", "merged"))
def numeric_coerce(spark, sf):
    """Text to number with unparsable text to NULL (address as text, device text)."""
    m = merged(spark, sf).select("TransactionID", F.col("addr1").cast("string").alias("addr1"), "DeviceInfo")
    return C.numeric_coerce(m, ["addr1", "DeviceInfo"])


# ---- E: scalar features ------------------------------------------------------------------------


@query("time_features", w("SELECT TransactionID, DT_day, DT_week, DT_hour FROM timed", "timed"))
def time_features(spark, sf):
    """Day, week and hour of the transaction time (floor division)."""
    return stages(spark, sf, until="filled").timed.select("TransactionID", "DT_day", "DT_week", "DT_hour")


@query("day_part", w("SELECT TransactionID, DT_hour, DT_day_part FROM timed", "timed"))
def day_part(spark, sf):
    """Night / morning / afternoon / evening from the hour."""
    return stages(spark, sf, until="filled").timed.select("TransactionID", "DT_hour", "DT_day_part")


@query("device_type_norm", w(f"SELECT TransactionID, DeviceType, {O.device_type_sql('DeviceType')} AS DeviceType_norm "
                             "FROM merged", "merged"))
def device_type_norm(spark, sf):
    """Normalised device type of the raw (unfilled) column."""
    return merged(spark, sf).select("TransactionID", "DeviceType", X.device_type_norm("DeviceType").alias("DeviceType_norm"))


@query("device_brand", w(f"SELECT TransactionID, DeviceInfo, {O.device_brand_sql('DeviceInfo')} AS DeviceInfo_brand "
                         "FROM merged", "merged"))
def device_brand(spark, sf):
    """Device brand from the raw device text."""
    return merged(spark, sf).select("TransactionID", "DeviceInfo", X.device_brand("DeviceInfo").alias("DeviceInfo_brand"))


@query("email_norm", w(f"SELECT TransactionID, {O.email_norm_sql('P_emaildomain')} AS P_norm, "
                       f"{O.email_norm_sql('R_emaildomain')} AS R_norm FROM tx", "tx"))
def email_norm(spark, sf):
    """E5: normalised payer / recipient e-mail domains of the raw columns."""
    t = fx.tx(spark, sf)
    return t.select("TransactionID", X.email_norm("P_emaildomain").alias("P_norm"),
                    X.email_norm("R_emaildomain").alias("R_norm"))


@query("email_provider", w("SELECT TransactionID, P_emaildomain_norm, P_emaildomain_provider, R_emaildomain_norm, "
                           "R_emaildomain_provider FROM email", "email"))
def email_provider(spark, sf):
    """Provider of each normalised domain."""
    return stages(spark, sf, until="email").email.select("TransactionID", "P_emaildomain_norm", "P_emaildomain_provider",
                                          "R_emaildomain_norm", "R_emaildomain_provider")


@query("email_same", w("SELECT TransactionID, email_same_domain, email_same_provider FROM email", "email"))
def email_same(spark, sf):
    """Same-domain and same-provider flags."""
    return stages(spark, sf, until="email").email.select("TransactionID", "email_same_domain", "email_same_provider")


@query("email_is_common", w("SELECT TransactionID, P_email_is_common, R_email_is_common FROM email", "email"))
def email_is_common(spark, sf):
    """Common-provider flags of both sides."""
    return stages(spark, sf, until="email").email.select("TransactionID", "P_email_is_common", "R_email_is_common")


@query("cross_features", w("""
SELECT TransactionID, CAST(card1 AS VARCHAR) || '_' || coalesce(CAST(addr1 AS VARCHAR), 'nan') AS card1_addr1,
       ProductCD || '_' || card4 AS ProductCD_card4, DeviceType_norm || '_' || ProductCD AS DeviceType_ProductCD
FROM device""", "device"))
def cross_features(spark, sf):
    """The three crossed text features."""
    return stages(spark, sf).crossed.select("TransactionID", "card1_addr1", "ProductCD_card4", "DeviceType_ProductCD")


def _app_text_sql(x):
    return "lower(" + O.strip(f"coalesce({x}, '')") + ")"


def _m_type_sql(x):
    s = _app_text_sql(x)
    return (f"CASE WHEN {s} IN ('', 'nan') THEN 'other' WHEN contains({s}, 'mobile') OR contains({s}, 'phone') THEN 'mobile' "
            f"WHEN contains({s}, 'desktop') OR contains({s}, 'pc') THEN 'desktop' ELSE 'other' END")


def _m_brand_sql(x):
    s = _app_text_sql(x)
    parts = [f"WHEN {s} IN ('', 'nan') THEN 'other'"]
    for keys, brand in X.APP_BRAND_RULES:
        parts.append("WHEN " + " OR ".join(f"contains({s}, {O.q(k)})" for k in keys) + f" THEN {O.q(brand)}")
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


def _m_email_sql(x):
    s = _app_text_sql(x)
    after = f"CASE WHEN instr({s}, '@') > 0 THEN substr({s}, instr({s}, '@') + 1) ELSE {s} END"
    head = f"split_part({after}, '.', 1)"
    return f"CASE WHEN {s} IN ('', 'nan') THEN 'unknown' WHEN {head} = '' THEN 'unknown' ELSE {head} END"


@query("m_device_type", w(f"SELECT TransactionID, {_m_type_sql('DeviceType')} AS m_device_type FROM merged", "merged"))
def m_device_type(spark, sf):
    """The scoring app's device type (mobile / desktop / other)."""
    return merged(spark, sf).select("TransactionID", X.m_device_type("DeviceType").alias("m_device_type"))


@query("m_device_brand", w(f"SELECT TransactionID, {_m_brand_sql('DeviceInfo')} AS m_device_brand FROM merged", "merged"))
def m_device_brand(spark, sf):
    """The scoring app's device brand."""
    return merged(spark, sf).select("TransactionID", X.m_device_brand("DeviceInfo").alias("m_device_brand"))


@query("m_email_provider", w(f"SELECT TransactionID, {_m_email_sql('P_emaildomain')} AS p_provider, "
                             f"{_m_email_sql('R_emaildomain')} AS r_provider FROM merged", "merged"))
def m_email_provider(spark, sf):
    """The scoring app's provider: text after the first '@', before the first '.'."""
    return merged(spark, sf).select("TransactionID", X.m_email_provider("P_emaildomain").alias("p_provider"),
                                    X.m_email_provider("R_emaildomain").alias("r_provider"))


@query("amount_log", w("SELECT TransactionID, CASE WHEN TransactionAmt IS NOT NULL THEN ln(1 + greatest(TransactionAmt, 0)) "
                       "END AS TransactionAmt_log FROM tx", "tx"))
def amount_log(spark, sf):
    """log1p of the clipped amount."""
    return fx.tx(spark, sf).select("TransactionID", N.amount_log("TransactionAmt").alias("TransactionAmt_log"))


O.cte("card_mean", ["tx"], "SELECT card1, avg(TransactionAmt) AS card1_avg_amt FROM tx GROUP BY card1 "
                           "HAVING avg(TransactionAmt) IS NOT NULL AND card1 IS NOT NULL")


@query("amount_ratio", w("""
SELECT t.TransactionID, t.TransactionAmt / CASE WHEN coalesce(m.card1_avg_amt, g.gm) = 0 THEN g.gm
                                               ELSE coalesce(m.card1_avg_amt, g.gm) END AS amt_to_card1_ratio
FROM tx t LEFT JOIN card_mean m ON t.card1 = m.card1,
     (SELECT coalesce(avg(TransactionAmt), 0.0) AS gm FROM tx) g""", "tx", "card_mean"))
def amount_ratio(spark, sf):
    """Amount over the card's mean amount (global mean for unseen cards and zero means)."""
    t = fx.tx(spark, sf)
    state, glob = B.card_mean_state(t)
    g = glob.first()[0]
    j = t.join(state, "card1", "left").withColumn("card1_avg_amt", F.coalesce("card1_avg_amt", F.lit(g)))
    return j.select("TransactionID", N.amount_ratio("TransactionAmt", "card1_avg_amt", g).alias("amt_to_card1_ratio"))


_RISK = ("CASE " + " ".join(f"WHEN p < {b} THEN {O.q(lbl)}" for b, lbl in N.RISK_BANDS) + f" ELSE {O.q(N.RISK_TOP)} END")


@query("risk_level", w(f"SELECT TransactionID, model, p, {_RISK} AS risk_level FROM scores", "scores"))
def risk_level(spark, sf):
    """Risk band of every score."""
    return fx.scores(spark, sf).select("TransactionID", "model", "p", N.risk_level("p").alias("risk_level"))


@query("zero_fill", w("SELECT TransactionID, coalesce(addr1, 0.0) AS addr1, coalesce(V1, 0.0) AS V1, "
                      "coalesce(id_sparse, 0.0) AS id_sparse FROM merged", "merged"))
def zero_fill(spark, sf):
    """NULL -> 0.0 in a feature list."""
    return merged(spark, sf).select("TransactionID", "addr1", "V1", "id_sparse").na.fill(0.0)


@query("amount_zscore", w("SELECT TransactionID, (TransactionAmt - avg(TransactionAmt) OVER ()) / "
                          "stddev_pop(TransactionAmt) OVER () AS amt_z FROM tx", "tx"))
def amount_zscore(spark, sf):
    """Amount standardisation listed among the reference's planned features: (x - mean) / population std."""
    t = fx.tx(spark, sf)
    r = t.agg(F.avg("TransactionAmt").alias("m"), F.stddev_pop("TransactionAmt").alias("sd")).first()
    return t.select("TransactionID", F.try_divide(F.col("TransactionAmt") - F.lit(r["m"]), F.lit(r["sd"])).alias("amt_z"))


# ---- F: per-card features ----------------------------------------------------------------------


def _beh(spark, sf, cols):
    return stages(spark, sf, until="behavior").behavior.select("TransactionID", *cols)


def _beh_sql(cols):
    return w(f"SELECT TransactionID, {_sql_list(cols)} FROM behavior", "behavior")


_F = {
    "card_amount_stats": (["card1_txn_cnt", "card1_amt_mean", "card1_amt_std"],
                          "F1: per card count, mean and std (ddof 1, NULL -> 0) of the amount, broadcast to rows."),
    "amt_div_card_mean": (["amt_div_card1_mean"], "F2: amount / (card mean + 1e-6)."),
    "recent3_stats": (["card1_recent3_amt_mean", "card1_recent3_amt_std"],
                      "F3: mean / std of the card's current and two previous amounts by (time, id)."),
    "card_addr_stats": (["card1_addr1_key", "card1_addr1_txn_cnt", "card1_addr1_amt_mean"],
                        "F4: count and mean amount per (card, address) key."),
    "time_since_last": (["time_since_last_tx_card1"], "F5: seconds since the card's previous transaction, -1 first."),
    "time_since_last_hours": (["time_since_last_tx_card1_hours"], "F6: F5 / 3600 (first row -1/3600)."),
    "time_since_first": (["time_since_first_tx_card1"], "F7: seconds since the card's first transaction."),
    "fr_card_addr": (["fr_card1_addr1"], "F8: fraud rate per (card, address)."),
    "fr_card_email": (["fr_card1_Pemailprov"], "F9: fraud rate per (card, payer provider)."),
}


def _make_f(name, cols, doc):
    def fn(spark, sf):
        return _beh(spark, sf, cols)

    fn.__doc__ = doc
    query(name, _beh_sql(cols))(fn)


for _n, (_c, _d) in _F.items():
    _make_f(_n, _c, _d)

_BEH_ALL = [c for cols, _ in _F.values() for c in cols]


@query("behavior_features", _beh_sql(_BEH_ALL))
def behavior_features(spark, sf):
    """F1-F9 in one plan straight from the derived table (no stored stage): narrow projection, per-card
    aggregates, skew-safe ordered ranks, one join back by TransactionID."""
    st = stages(spark, sf, until="email")
    return B.behavior_features(st.email).select("TransactionID", *_BEH_ALL)


@query("order_restore", w(f"SELECT TransactionID, card1, TransactionDT, {_sql_list(_BEH_ALL)} FROM behavior "
                          "ORDER BY TransactionID", "behavior"))
def order_restore(spark, sf):
    """the behaviour table back in input (TransactionID) order."""
    return stages(spark, sf, until="behavior").behavior.select("TransactionID", "card1", "TransactionDT", *_BEH_ALL).orderBy("TransactionID")


@query("drift_by_week", w("SELECT DT_week, count(*) AS n_samples, avg(CAST(isFraud AS DOUBLE)) AS fraud_rate FROM timed "
                          "GROUP BY DT_week ORDER BY DT_week", "timed"))
def drift_by_week(spark, sf):
    """rows and fraud rate per week (merge -> clean -> week -> group)."""
    return B.drift_by_week(stages(spark, sf, until="filled").timed)


@query("card_mean_map", w("SELECT 'card1' AS col, CAST(card1 AS VARCHAR) AS key, card1_avg_amt AS value FROM card_mean "
                          "UNION ALL SELECT '__global__', NULL, coalesce(avg(TransactionAmt), 0.0) FROM tx", "card_mean"))
def card_mean_map(spark, sf):
    """fitted card-mean map and global mean as a (col, key, value) state."""
    state, glob = B.card_mean_state(fx.tx(spark, sf))
    st = state.select(F.lit("card1").alias("col"), F.col("card1").cast("string").alias("key"),
                      F.col("card1_avg_amt").alias("value"))
    g = glob.select(F.lit("__global__").alias("col"), F.lit(None).cast("string").alias("key"),
                    F.col("global_amt_mean").alias("value"))
    return st.unionByName(g)
