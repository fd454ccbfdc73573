"""CSV scans without a schema (A1): column types from the whole file, as pandas would read it.

Every column is read as text. One aggregate, combined per task, finds for each column the highest level that any of its
values needs in the order empty < long < double < text (booleans are a level beside the numbers) and whether a value is
missing. Types follow from that alone: a whole-number column with missing values is double; a boolean one keeps its type and
has NULLs. A record with more fields than the header goes to a table of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.settings import DEFAULT, Settings

# Fixed values (reference): the texts that its CSV reader takes as missing.
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                 "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# Fixed values (reference): the texts that it takes as booleans.
TRUE_TEXTS, FALSE_TEXTS = ["True", "TRUE", "true"], ["False", "FALSE", "false"]

_SPACES = r"^[ \t]+|[ \t]+$"
_LONG = r"^[+-]?[0-9]+$"
_DOUBLE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INFINITE = r"(?i)^[+-]?inf(inity)?$"
_NUMBERS, _FLAGS, _TEXT = 1, 2, 4  # bits of what a column holds; numbers have a second bit beside them
_BROKEN = 8
_EXTRA = "_more_fields"


@dataclass
class CsvScan:
    """``rows``: the typed table; ``types``: column -> type name; ``quarantine``: records with too many fields, as text."""

    rows: DataFrame
    types: dict[str, str]
    quarantine: DataFrame


def _missing(x: Column) -> Column:
    return x.isNull() | x.isin(MISSING_TEXTS)


def _level(x: Column) -> Column:
    """Bits of a present value: whole number, broken number, flag or text; NULL for a missing one."""
    n = F.regexp_replace(x, _SPACES, "")
    whole = n.rlike(_LONG) & n.try_cast("bigint").isNotNull()
    number = n.rlike(_DOUBLE) | n.rlike(_INFINITE)
    return (F.when(_missing(x), F.lit(None).cast("int")).when(whole, _NUMBERS).when(number, _NUMBERS | _BROKEN)
            .when(x.isin(TRUE_TEXTS + FALSE_TEXTS), _FLAGS).otherwise(_TEXT))


def _type(bits: int | None, missing: bool) -> str:
    if bits is None:  # nothing but missing values
        return "double"
    if bits & _TEXT or bits & _FLAGS and bits & _NUMBERS:
        return "string"
    if bits & _FLAGS:
        return "boolean"
    return "double" if bits & _BROKEN or missing else "bigint"


def _number(x: Column) -> Column:
    n = F.regexp_replace(x, _SPACES, "")
    sign = F.when(n.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(n.rlike(_INFINITE), sign).otherwise(n.try_cast("double"))


def _typed(c: str, kind: str) -> Column:
    x = F.col(f"`{c}`")
    value = {"bigint": F.regexp_replace(x, _SPACES, "").try_cast("bigint"), "double": _number(x),
             "boolean": x.isin(TRUE_TEXTS), "string": x}[kind]
    return F.when(~_missing(x), value).alias(c)


def _text_rows(spark: SparkSession, path: str, names: list[str], sep: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _EXTRA]])
    return (spark.read.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", True)
            .option("quote", '"').option("escape", '"').option("multiLine", False).option("mode", "PERMISSIVE").csv(path))


def infer_types(rows: DataFrame, names: list[str], s: Settings = DEFAULT) -> dict[str, str]:
    """Column -> type of a table of texts; one pass per ``agg_chunk`` columns."""
    out = {}
    for i in range(0, len(names), s.agg_chunk):
        chunk = names[i: i + s.agg_chunk]
        aggs = []
        for k, c in enumerate(chunk):
            x = F.col(f"`{c}`")
            aggs += [F.bit_or(_level(x)).alias(f"b{k}"), F.max(_missing(x)).alias(f"m{k}")]
        row = rows.agg(*aggs).first()
        out.update({c: _type(row[f"b{k}"], bool(row[f"m{k}"])) for k, c in enumerate(chunk)})
    return out


def scan_csv(spark: SparkSession, path: str, sep: str = ",", s: Settings = DEFAULT) -> CsvScan:
    """The CSV file or folder at ``path`` (each file with a header, the same one), typed by its values."""
    names = (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
             .option("inferSchema", False).csv(path).columns)
    text = _text_rows(spark, path, names, sep)
    whole = text.where(F.col(_EXTRA).isNull()).drop(_EXTRA)
    types = infer_types(whole, names, s)
    return CsvScan(whole.select(*[_typed(c, types[c]) for c in names]), types, text.where(F.col(_EXTRA).isNotNull()))
