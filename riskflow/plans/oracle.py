"""DuckDB text of the fixtures and of every checked query (the independent SQL oracle).

``with_ctes(body, *names)`` prefixes ``body`` with the named CTEs and whatever they
depend on, in dependency order. The CTEs re-derive the same stand-in tables as
``riskflow.sources.fixtures`` from the pre-registered ``events`` view.
"""

from __future__ import annotations

from riskflow.functions.hashing import hash32_sql as H
from riskflow.sources.fixtures import (
    CARD_NETWORKS,
    DEVICE_INFOS,
    DEVICE_TYPES,
    DOMAINS,
    PHI_FEATURES,
    PRODUCTS,
    SCORE_MODELS,
)


def _lst(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


_CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], text: str) -> None:
    _CTES[name] = (deps, text)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    if body.lstrip().upper().startswith("WITH"):
        body = f"SELECT * FROM ({body}) q_"
    return "WITH " + ",\n".join(f"{n} AS (\n{_CTES[n][1]}\n)" for n in order) + "\n" + body


cte("ev", [], """
SELECT event_id, user_id, value,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
       CAST(floor(date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 1000000) AS BIGINT) AS secs
FROM events""")

cte("tx", ["ev"], f"""
SELECT event_id AS TransactionID,
       CAST(CASE WHEN {H('event_id', "'y'")} % 100 <
                 (CASE WHEN value > 100 THEN 40 WHEN k % 10 = 0 THEN 25 ELSE 3 END) THEN 1 ELSE 0 END AS INTEGER) AS isFraud,
       secs AS TransactionDT,
       value AS TransactionAmt,
       {_lst(PRODUCTS)}[k % 5 + 1] AS ProductCD,
       user_id AS card1,
       {_lst(CARD_NETWORKS)}[user_id % 4 + 1] AS card4,
       CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS addr1,
       {_lst(DOMAINS)}[user_id % 12 + 1] AS P_emaildomain,
       {_lst(DOMAINS)}[CAST(floor((event_id % 36) / 3) AS BIGINT) + 1] AS R_emaildomain,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * 2 END AS V1
FROM ev""")

cte("identity", [], f"""
SELECT event_id AS TransactionID,
       {_lst(DEVICE_TYPES)}[user_id % 4 + 1] AS DeviceType,
       {_lst(DEVICE_INFOS)}[event_id % 13 + 1] AS DeviceInfo,
       CASE WHEN event_id % 200 = 0 THEN CAST(1.0 AS DOUBLE) END AS id_sparse,
       CAST(1 AS INTEGER) AS id_const
FROM events WHERE event_id % 4 = 0""")

cte("merged", ["tx", "identity"], """
SELECT tx.*, identity.DeviceType, identity.DeviceInfo, identity.id_sparse, identity.id_const
FROM tx LEFT JOIN identity ON tx.TransactionID = identity.TransactionID""")

_models = ", ".join(f"'{m}'" for m in SCORE_MODELS)
cte("scores", ["tx"], f"""
SELECT TransactionID, model, isFraud AS y,
       CAST({H('TransactionID', 'model')} % 600 + 350 * isFraud * ({H('TransactionID', "'s' || model")} % 2) AS DOUBLE) / 1000 AS p
FROM (SELECT TransactionID, isFraud, unnest([{_models}]) AS model FROM tx) t""")

cte("phi", ["tx"], f"""
SELECT TransactionID, y, printf('f%02d', fidx) AS feature,
       CAST({H('TransactionID * 100 + fidx', "'val'")} % 97 AS DOUBLE) AS value,
       CAST({H('TransactionID * 100 + fidx', "'phi'")} % 2001 - 1000 AS DOUBLE) / 1000 AS phi
FROM (SELECT TransactionID, isFraud AS y, unnest(range(0, {PHI_FEATURES})) AS fidx FROM tx) t""")


# ---- pipeline stages in SQL ---------------------------------------------------------------------
from riskflow.functions.text import (  # noqa: E402
    APP_BRAND_RULES,
    COMMON_PROVIDERS,
    DEVICE_BRAND_RULES,
    EMAIL_CONTAINS_RULES,
    EMAIL_PROVIDER_MAP,
)

WS = r"'^\s+|\s+$'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {WS}, '', 'g')"


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


# median fill of the numeric columns with NULLs (addr1, V1) and 'missing' for text; id_sparse and
# id_const are the columns D1 / D2 drop on this fixture
cte("filled", ["merged"], """
SELECT TransactionID, isFraud, TransactionDT, TransactionAmt,
       coalesce(ProductCD, 'missing') AS ProductCD, card1, coalesce(card4, 'missing') AS card4,
       coalesce(addr1, (SELECT median(addr1) FROM merged)) AS addr1,
       coalesce(P_emaildomain, 'missing') AS P_emaildomain, coalesce(R_emaildomain, 'missing') AS R_emaildomain,
       coalesce(V1, (SELECT median(V1) FROM merged)) AS V1,
       coalesce(DeviceType, 'missing') AS DeviceType, coalesce(DeviceInfo, 'missing') AS DeviceInfo
FROM merged""")


def time_sql(dt: str = "TransactionDT") -> str:
    day = f"CAST(floor({dt} / 86400) AS INTEGER)"
    hour = f"CAST(((floor({dt} / 3600) % 24) + 24) % 24 AS INTEGER)"
    return (f"{day} AS DT_day, CAST(floor({day} / 7) AS INTEGER) AS DT_week, {hour} AS DT_hour, "
            f"CASE WHEN {hour} <= -1 THEN 'nan' WHEN {hour} <= 6 THEN 'night' WHEN {hour} <= 12 THEN 'morning' "
            f"WHEN {hour} <= 18 THEN 'afternoon' WHEN {hour} <= 24 THEN 'evening' ELSE 'nan' END AS DT_day_part")


cte("timed", ["filled"], f"SELECT *, {time_sql()} FROM filled")


def device_type_sql(x: str) -> str:
    s = f"coalesce({x}, 'nan')"
    return (f"CASE WHEN {strip(s)} = '' THEN 'unknown' WHEN contains(lower({s}), 'mobile') THEN 'mobile' "
            f"WHEN contains(lower({s}), 'desktop') THEN 'desktop' ELSE lower({s}) END")


def device_brand_sql(x: str) -> str:
    raw = f"coalesce({x}, 'nan')"
    s = f"lower({strip(raw)})"
    parts = [f"WHEN {s} = '' THEN 'unknown'"]
    for keys, brand in DEVICE_BRAND_RULES:
        cond = " OR ".join(f"contains({s}, {q(k)})" for k in keys)
        parts.append(f"WHEN {cond} THEN {q(brand)}")
    tail = f"left(split_part(string_split_regex({s}, '\\s+')[1], '/', 1), 20)"
    return "CASE " + " ".join(parts) + f" ELSE {tail} END"


cte("device", ["timed"], f"""
SELECT *, {device_type_sql('DeviceType')} AS DeviceType_norm, {device_brand_sql('DeviceInfo')} AS DeviceInfo_brand
FROM timed""")


def email_norm_sql(x: str) -> str:
    s = f"coalesce({x}, 'nan')"
    return f"CASE WHEN {strip(s)} = '' OR lower({s}) = 'nan' THEN 'unknown' ELSE lower({strip(s)}) END"


def email_provider_sql(d: str) -> str:
    parts = [f"WHEN {d} IS NULL THEN 'other'"]
    parts += [f"WHEN {d} = {q(k)} THEN {q(v)}" for k, v in EMAIL_PROVIDER_MAP.items()]
    parts.append(f"WHEN {d} = 'unknown' THEN 'unknown'")
    parts += [f"WHEN contains({d}, {q(k)}) THEN {q(v)}" for k, v in EMAIL_CONTAINS_RULES]
    parts.append(f"WHEN suffix({d}, '.edu') OR contains({d}, '.edu.') THEN 'edu'")
    parts.append(f"WHEN suffix({d}, '.gov') OR contains({d}, '.gov.') THEN 'gov'")
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


_common = ", ".join(q(c) for c in COMMON_PROVIDERS)
cte("email0", ["device"], f"""
SELECT *, {email_norm_sql('P_emaildomain')} AS P_emaildomain_norm, {email_norm_sql('R_emaildomain')} AS R_emaildomain_norm
FROM device""")
cte("email1", ["email0"], f"""
SELECT *, {email_provider_sql('P_emaildomain_norm')} AS P_emaildomain_provider,
       {email_provider_sql('R_emaildomain_norm')} AS R_emaildomain_provider
FROM email0""")
cte("email", ["email1"], f"""
SELECT *, CAST(P_emaildomain_norm = R_emaildomain_norm AS INTEGER) AS email_same_domain,
       CAST(P_emaildomain_provider = R_emaildomain_provider AS INTEGER) AS email_same_provider,
       CAST(P_emaildomain_provider IN ({_common}) AS INTEGER) AS P_email_is_common,
       CAST(R_emaildomain_provider IN ({_common}) AS INTEGER) AS R_email_is_common
FROM email1""")

cte("behavior", ["email"], """
SELECT *,
       CAST(count(TransactionAmt) OVER pc AS INTEGER) AS card1_txn_cnt,
       avg(TransactionAmt) OVER pc AS card1_amt_mean,
       coalesce(stddev_samp(TransactionAmt) OVER pc, 0.0) AS card1_amt_std,
       TransactionAmt / (avg(TransactionAmt) OVER pc + 1e-6) AS amt_div_card1_mean,
       avg(TransactionAmt) OVER w3 AS card1_recent3_amt_mean,
       coalesce(stddev_samp(TransactionAmt) OVER w3, 0.0) AS card1_recent3_amt_std,
       coalesce(CAST(TransactionDT - lag(TransactionDT) OVER wo AS DOUBLE), -1.0) AS time_since_last_tx_card1,
       coalesce(CAST(TransactionDT - lag(TransactionDT) OVER wo AS DOUBLE), -1.0) / 3600.0 AS time_since_last_tx_card1_hours,
       CAST(TransactionDT - min(TransactionDT) OVER pc AS DOUBLE) AS time_since_first_tx_card1,
       CAST(card1 AS VARCHAR) || '_' || coalesce(CAST(addr1 AS VARCHAR), 'nan') AS card1_addr1_key,
       CAST(count(TransactionAmt) OVER pk AS INTEGER) AS card1_addr1_txn_cnt,
       avg(TransactionAmt) OVER pk AS card1_addr1_amt_mean,
       CASE WHEN card1 IS NOT NULL AND addr1 IS NOT NULL THEN avg(CAST(isFraud AS DOUBLE)) OVER pk END AS fr_card1_addr1,
       CASE WHEN card1 IS NOT NULL THEN avg(CAST(isFraud AS DOUBLE)) OVER pp END AS fr_card1_Pemailprov
FROM email
WINDOW pc AS (PARTITION BY card1),
       wo AS (PARTITION BY card1 ORDER BY TransactionDT, TransactionID),
       w3 AS (PARTITION BY card1 ORDER BY TransactionDT, TransactionID ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
       pk AS (PARTITION BY card1, addr1),
       pp AS (PARTITION BY card1, P_emaildomain_provider)""")
