"""String normalisers for device and e-mail fields, as native column expressions.

Two families: the feature pipeline's rules (device type/brand, e-mail domain and
provider) and the scoring app's rules (``m_*``). A pandas ``astype(str)`` turns a
missing cell into the text ``'nan'``; the pipeline variants reproduce that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() / str.split() work on whitespace runs.
_WS_EDGES = r"^\s+|\s+$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _strip(x: Column) -> Column:
    return F.regexp_replace(x, _WS_EDGES, "")


def _blank(x: Column) -> Column:
    return _strip(x) == F.lit("")


def device_type_norm(x: Column | str) -> Column:
    """blank -> unknown; contains 'mobile' -> mobile; 'desktop' -> desktop; else lower(x) (untrimmed)."""
    s = F.coalesce(_c(x), F.lit("nan"))
    low = F.lower(s)
    return (
        F.when(_blank(s), F.lit("unknown"))
        .when(low.contains("mobile"), F.lit("mobile"))
        .when(low.contains("desktop"), F.lit("desktop"))
        .otherwise(low)
    )


# Fixed values (reference): keyword -> brand, checked in this order on the trimmed lower-case text.
DEVICE_BRAND_RULES = [
    (("iphone", "ios"), "apple"),
    (("ipad",), "apple_ipad"),
    (("mac",), "apple_mac"),
    (("android",), "android"),
    (("windows",), "windows"),
    (("linux",), "linux"),
]


def device_brand(x: Column | str) -> Column:
    """Keyword rules above; else first whitespace token, before the first '/', at most 20 chars."""
    raw = F.coalesce(_c(x), F.lit("nan"))
    s = F.lower(_strip(raw))
    e = F.when(s == F.lit(""), F.lit("unknown"))
    for keys, brand in DEVICE_BRAND_RULES:
        cond = None
        for k in keys:
            cond = s.contains(k) if cond is None else (cond | s.contains(k))
        e = e.when(cond, F.lit(brand))
    first_token = F.split(s, r"\s+").getItem(0)
    return e.otherwise(F.substring(F.substring_index(first_token, "/", 1), 1, 20))


def email_norm(x: Column | str) -> Column:
    """blank or 'nan' -> unknown; else trim + lower."""
    s = F.coalesce(_c(x), F.lit("nan"))
    return F.when(_blank(s) | (F.lower(s) == F.lit("nan")), F.lit("unknown")).otherwise(F.lower(_strip(s)))


# Fixed values (reference): exact domain -> provider map, in the reference's order.
EMAIL_PROVIDER_MAP = {
    "gmail.com": "gmail",
    "googlemail.com": "gmail",
    "yahoo.com": "yahoo",
    "yahoo.co.uk": "yahoo",
    "yahoo.co.jp": "yahoo",
    "hotmail.com": "microsoft",
    "outlook.com": "microsoft",
    "live.com": "microsoft",
    "qq.com": "china_qq",
    "163.com": "china_163",
    "126.com": "china_126",
    "sina.com": "china_sina",
    "sina.com.cn": "china_sina",
}
# Fixed values (reference): fallback substring rules after the exact map.
EMAIL_CONTAINS_RULES = [("qq.com", "china_qq"), ("163.com", "china_163"), ("126.com", "china_126"), ("sina", "china_sina")]
# Fixed values (reference): providers counted as common.
COMMON_PROVIDERS = ["gmail", "china_qq", "china_163", "microsoft", "yahoo"]


def email_provider(domain: Column | str) -> Column:
    """Provider of a normalised domain: exact map, 'unknown', substring rules, edu, gov, else other."""
    d = _c(domain)
    mapping = F.create_map(*[F.lit(v) for kv in EMAIL_PROVIDER_MAP.items() for v in kv])
    hit = F.try_element_at(mapping, d)
    e = F.when(d.isNull(), F.lit("other")).when(hit.isNotNull(), hit)
    e = e.when(d == F.lit("unknown"), F.lit("unknown"))
    for k, prov in EMAIL_CONTAINS_RULES:
        e = e.when(d.contains(k), F.lit(prov))
    e = e.when(d.endswith(".edu") | d.contains(".edu."), F.lit("edu"))
    e = e.when(d.endswith(".gov") | d.contains(".gov."), F.lit("gov"))
    return e.otherwise(F.lit("other"))


def email_is_common(provider: Column | str) -> Column:
    return _c(provider).isin(COMMON_PROVIDERS).cast("int")


# ---- scoring-app variants --------------------------------------------------------------------


def _app_text(x: Column | str) -> Column:
    """The app's ``str(x).strip().lower()`` with None -> ''."""
    return F.lower(_strip(F.coalesce(_c(x), F.lit(""))))


def m_device_type(x: Column | str) -> Column:
    s = _app_text(x)
    return (
        F.when(s.isin("", "nan"), F.lit("other"))
        .when(s.contains("mobile") | s.contains("phone"), F.lit("mobile"))
        .when(s.contains("desktop") | s.contains("pc"), F.lit("desktop"))
        .otherwise(F.lit("other"))
    )


# Fixed values (reference): the app's brand keywords, checked in this order.
APP_BRAND_RULES = [
    (("iphone", "ipad", "mac", "ios", "apple"), "apple"),
    (("android",), "android"),
    (("huawei", "honor"), "huawei"),
    (("xiaomi", "redmi", "mi "), "xiaomi"),
    (("oppo",), "oppo"),
    (("vivo",), "vivo"),
    (("samsung",), "samsung"),
    (("windows",), "windows"),
    (("linux",), "linux"),
]


def m_device_brand(x: Column | str) -> Column:
    s = _app_text(x)
    e = F.when(s.isin("", "nan"), F.lit("other"))
    for keys, brand in APP_BRAND_RULES:
        cond = None
        for k in keys:
            cond = s.contains(k) if cond is None else (cond | s.contains(k))
        e = e.when(cond, F.lit(brand))
    return e.otherwise(F.lit("other"))


def m_email_provider(x: Column | str) -> Column:
    """Text after the first '@' (if any), then before the first '.'; empty -> unknown."""
    s = _app_text(x)
    pos = F.instr(s, "@")
    after_at = F.when(pos > 0, F.substr(s, pos + F.lit(1))).otherwise(s)
    head = F.substring_index(after_at, ".", 1)
    return F.when(s.isin("", "nan"), F.lit("unknown")).when(head == F.lit(""), F.lit("unknown")).otherwise(head)
