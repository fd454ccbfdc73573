"""Splits, samples and weights (I1-I6) as pure functions of the row key.

Each row gets ``h = hash32(id, seed)``; the validation part of a class is the
``round(valid_size * n_class)`` rows with the smallest (h, id). The rank inside a
class comes from ``ordered_prefix`` (parallel buckets), not from a window over the
whole class: a class label is a hot key (one class holds ~97 % of the rows).
Re-evaluating the function rebuilds the same split anywhere (I2).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.hashing import hash32
from riskflow.operators.ordered import bucket_count, ordered_prefix
from riskflow.settings import DEFAULT, Settings

MAX_CLASSES = 10_000


def _class_counts(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes; not a class label")
    return {r[label]: r["count"] for r in rows}


def _class_map(values: dict, label: str, default=None):
    e = None
    for k, v in values.items():
        cond = F.col(label).isNull() if k is None else (F.col(label) == F.lit(k))
        e = F.when(cond, F.lit(v)) if e is None else e.when(cond, F.lit(v))
    return e.otherwise(F.lit(default)) if e is not None else F.lit(default)


def class_ranks(df: DataFrame, label: str = DEFAULT.target, id_col: str = DEFAULT.id_col, seed: int = DEFAULT.seed,
                s: Settings = DEFAULT) -> DataFrame:
    """Rank (1-based) of every row inside its class under (hash32(id, seed), id)."""
    d = df.withColumn("_h", hash32(id_col, str(seed)))
    return ordered_prefix(d, order=["_h", id_col], by=[label], bucket=hash_bucket(bucket_count(df.count(), s)), s=s).drop("_h")


def hash_bucket(n: int, below: int = 2**32) -> Column:
    """The one of ``n`` equal ranges of [0, below) that the uniform 32-bit hash ``_h`` lies in: no quantile pass, no splits."""
    return F.floor(F.col("_h") * F.lit(n / below))


def stratified_split(df: DataFrame, label: str = DEFAULT.target, id_col: str = DEFAULT.id_col,
                     valid_size: float = DEFAULT.valid_size, seed: int = DEFAULT.seed,
                     s: Settings = DEFAULT) -> DataFrame:
    """Adds ``is_valid``; each class contributes round(valid_size * n_class) rows to validation.

    All rows are kept; a NULL label is a class of its own. More than ``MAX_CLASSES`` classes raise.
    """
    counts = _class_counts(df, label)
    k = {c: int((valid_size * n) + 0.5) for c, n in counts.items()}
    r = class_ranks(df, label, id_col, seed, s)
    return r.withColumn("is_valid", F.col("_rank") <= _class_map(k, label, 0)).drop("_rank")


def split_index(df: DataFrame, label: str = DEFAULT.target, id_col: str = DEFAULT.id_col,
                valid_size: float = DEFAULT.valid_size, seed: int = DEFAULT.seed, s: Settings = DEFAULT) -> DataFrame:
    """The validation row keys, rebuilt from the seed."""
    return stratified_split(df.select(id_col, label), label, id_col, valid_size, seed, s).where("is_valid").select(id_col)


def stratified_kfold(df: DataFrame, n_folds: int = DEFAULT.n_folds, label: str = DEFAULT.target,
                     id_col: str = DEFAULT.id_col, seed: int = DEFAULT.seed, s: Settings = DEFAULT) -> DataFrame:
    """``fold`` in 1..n_folds, dealt round-robin along the hash order inside each class."""
    r = class_ranks(df, label, id_col, seed, s)
    return r.withColumn("fold", ((F.col("_rank") - 1) % n_folds + 1).cast("int")).drop("_rank")


def subsample_n(df: DataFrame, n: int, id_col: str = DEFAULT.id_col, seed: int = DEFAULT.seed,
                s: Settings = DEFAULT) -> DataFrame:
    """I4: exactly min(n, rows) rows without replacement: the n smallest (hash32(id, seed), id).

    Rows under a cut of the uniform hash are candidates. The cut leaves n + 10 sqrt(n) + 100 of them on average (ten standard
    deviations of slack; should they still be too few, it is doubled), only their (hash, id) pairs are ranked, and the n-th pair
    filters the table, which is neither stored nor shuffled. Rows with the n-th row's id go in together.
    """
    rows = df.count()
    if n >= rows:
        return df
    h = hash32(id_col, str(seed))
    share = (n + 10 * math.sqrt(n) + 100) / rows
    while True:
        cut = int(share * 2**32) + 1
        near = df.select(h.alias("_h"), F.col(id_col).alias("_id")).where(F.col("_h") < cut)
        found = near.count()
        if found >= n or cut > 2**32:
            break
        share *= 2
    size = max(1, math.ceil(found / s.rows_per_bucket), s.min_buckets)
    last = ordered_prefix(near, order=["_h", "_id"], bucket=hash_bucket(size, min(cut, 2**32)), s=s).where(F.col("_rank") == n).select("_h", "_id").first()
    if last is None:  # null ids have no hash; they come last
        return df.where(h.isNotNull())
    return df.where((h < F.lit(last["_h"])) | ((h == F.lit(last["_h"])) & (F.col(id_col) <= F.lit(last["_id"]))))


def balanced_weight(df: DataFrame, label: str = DEFAULT.target, out: str = "weight") -> DataFrame:
    """``n / (n_classes * n_class)`` per row (the 'balanced' class weight)."""
    counts = _class_counts(df, label)
    n = sum(counts.values())
    wts = {c: n / (len(counts) * m) for c, m in counts.items()}
    return df.withColumn(out, _class_map(wts, label).cast("double"))


def scale_pos_weight(df: DataFrame, label: str = DEFAULT.target, out: str = "weight") -> tuple[DataFrame, float]:
    """r = negatives / max(positives, 1); positives weigh r, negatives 1."""
    counts = _class_counts(df, label)
    pos = counts.get(1, 0)
    neg = sum(v for k, v in counts.items() if k != 1)
    r = neg / max(pos, 1)
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(r)).otherwise(F.lit(1.0))), r
