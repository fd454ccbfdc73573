"""Column expressions (JVM-side, codegen-friendly): no Python UDF anywhere."""

from riskflow.functions.hashing import hash32
from riskflow.functions.numeric import (
    amount_log,
    amount_ratio,
    day_part,
    nan_to_null,
    py_str,
    risk_level,
    time_features,
)
from riskflow.functions.text import (
    device_brand,
    device_type_norm,
    email_is_common,
    email_norm,
    email_provider,
    m_device_brand,
    m_device_type,
    m_email_provider,
)

__all__ = [
    "hash32",
    "amount_log",
    "amount_ratio",
    "day_part",
    "nan_to_null",
    "py_str",
    "risk_level",
    "time_features",
    "device_brand",
    "device_type_norm",
    "email_is_common",
    "email_norm",
    "email_provider",
    "m_device_brand",
    "m_device_type",
    "m_email_provider",
]
