"""Global order statistics without a single-partition window.

``ordered_prefix`` gives every row its 1-based rank inside its group and the
running totals of some columns, under a total order. A plain
``Window.partitionBy(group).orderBy(...)`` sends a whole group to one task,
which fails when one group (a class label, a hot card, one model's scores)
holds a large share of the rows. Here the rows are cut into quantile buckets of
the first order column (``percentile_approx`` -> ``Bucketizer``), ranked and
summed inside each (group, bucket) window in parallel, and shifted by the
totals of the earlier buckets, which form a small table of at most
groups x buckets rows.

The first cut has at most ``FIRST`` buckets. Those that hold too many rows are cut again by quantiles of their own,
computed per bucket and joined to the rows, so no array of splits grows with the table. A split value is a bucket of its
own, and a bucket of a single value (a hot value, or NULL) is cut by the second order column.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskflow.functions.numeric import nan_to_null
from riskflow.session import cut_lineage
from riskflow.settings import DEFAULT, Settings


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_count(n_rows: int, s: Settings = DEFAULT) -> int:
    return max(math.ceil(n_rows / s.rows_per_bucket), s.min_buckets)


FIRST = 1024   # most buckets of the first cut
FAN = 64       # quantile steps of every later cut
SENT = 50_000  # most buckets whose cuts, half a KB each, are sent to all tasks


def _next_keys(df: DataFrame, order: list[Column]) -> list[Column]:
    """The first two order columns as doubles that ascend with the order; one where the second is no number."""
    kinds = df.select(*[o.alias(f"k{i}") for i, o in enumerate(order[:2])]).schema.fields
    return [nan_to_null(o.cast("double")) for i, (o, f) in enumerate(zip(order, kinds)) if i == 0 or isinstance(f.dataType, NumericType)]


def _cut_again(d: DataFrame, keys: list[Column], s: Settings) -> DataFrame | None:
    """``d`` with the buckets ``_b`` of more than two times ``rows_per_bucket`` rows cut; None if none can be."""
    probs = [i / FAN for i in range(1, FAN)]
    k = [f"_k{i}" for i in range(len(keys))]
    narrow = d.select("_b", *[x.alias(n) for x, n in zip(keys, k)])
    aggs = [a for n in k for a in (F.min(n).alias(f"{n}lo"), F.max(n).alias(f"{n}hi"), F.count(n).alias(f"{n}n"),
                                   F.percentile_approx(n, probs, 10_000).alias(f"{n}q"))]
    sizes = narrow.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"), *aggs).where(F.col("_n") > 2 * s.rows_per_bucket)
    several = [(F.col(f"{n}lo") < F.col(f"{n}hi")) | F.col(f"{n}n").between(1, F.col("_n") - 1) for n in k]
    by = F.lit(None).cast("int")
    for i in reversed(range(len(k))):
        by = F.when(several[i], F.lit(i)).otherwise(by)
    q = F.get(F.array(*[F.array_distinct(f"{n}q") for n in k]), F.col("_by"))
    sizes = sizes.withColumn("_by", by).where("_by is not null").select("_b", "_by", q.alias("_q"))
    sizes = cut_lineage(sizes, "bucket-cuts")  # a row per large bucket
    large = sizes.count()
    if not large:
        return None
    x = F.get(F.array(*keys), F.col("_by"))
    below = F.size(F.filter("_q", lambda e: e < x))
    step = F.when(F.col("_q").isNull(), F.lit(0)).when(x.isNull(), F.lit(2 * FAN)).otherwise(
        2 * below + F.array_contains("_q", x).cast("int"))
    sizes = F.broadcast(sizes) if large <= SENT else sizes
    return d.join(sizes, "_b", "left").withColumn("_b", F.col("_b") * (4 * FAN) + step).drop("_by", "_q")


def bucketed(df: DataFrame, order: list[Column], s: Settings = DEFAULT) -> DataFrame:
    """``df`` with a bucket number ``_b`` that ascends with ``order``; NaN and then NULL first keys come last.

    One pass gives the row count and a first grid of quantiles, which only a table of more than ``rows_per_bucket`` rows per
    grid cell refines. Rows with equal values of both cutting columns stay together.
    """
    keys = _next_keys(df, order)
    quantiles = lambda n: F.percentile_approx(keys[0], [i / n for i in range(1, n)], max(10_000, 10 * n))
    grid = 4 * s.min_buckets
    row = df.agg(F.count(F.lit(1)).alias("n"), quantiles(grid).alias("q")).first()
    n, q = row["n"], row["q"]
    if bucket_count(n, s) > grid:
        q = df.agg(quantiles(min(bucket_count(n, s), FIRST)).alias("q")).first()["q"]
    splits = [-math.inf, *(sorted({float(x) for x in q or []}) or [0.0]), math.inf]
    d = df.withColumn("_okey", F.coalesce(keys[0], F.lit(math.inf)))
    d = Bucketizer(splits=splits, inputCol="_okey", outputCol="_b").transform(d).drop("_okey")
    last = F.when(keys[0].isNull(), F.lit(len(splits)) + order[0].isNull().cast("int"))  # NaN before NULL
    d = d.withColumn("_b", F.coalesce(last, F.col("_b")).cast("bigint"))
    for _ in range(5):  # 8 bits of the number each
        cut = _cut_again(d, keys, s) if n > 2 * s.rows_per_bucket else None
        if cut is None:
            break
        d = cut
    return d


def ordered_prefix(
    df: DataFrame,
    order: list[Column | str],
    by: list[str] = (),
    sums: list[str] = (),
    rank_col: str = "_rank",
    cum_prefix: str = "cum_",
    s: Settings = DEFAULT,
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``rank_col`` (1-based, within ``by``, ascending ``order``) and ``cum_<c>`` inclusive running sums.

    ``order`` must be a total order (end it with a unique key) and its first item numeric. Every row is kept: NULL order
    keys come last (after NaN), NULL group keys are one group. ``bucket``, a number that ascends with the order (NULL: last),
    replaces the quantile pass where the first key's distribution is known. The ranked buckets are stored once; the totals are read from them.
    """
    by = list(by)
    order_cols = [_col(o) for o in order]
    if bucket is None:
        d = bucketed(df, order_cols, s)
    else:
        d = df.withColumn("_b", F.coalesce(bucket.cast("bigint"), F.lit(2**62)))
    part = [*by, "_b"]
    w_rank = Window.partitionBy(*part).orderBy(*[c.asc_nulls_last() for c in order_cols])
    w_run = w_rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_lr", F.row_number().over(w_rank))
    for c in sums:
        d = d.withColumn(f"_lc_{c}", F.sum(c).over(w_run))
    d = cut_lineage(d, "prefix")
    tot = d.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_bn"), *[F.sum(c).alias(f"_bs_{c}") for c in sums]
    )
    w_b = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(
        *part,
        F.coalesce(F.sum("_bn").over(w_b), F.lit(0)).alias("_on"),
        *[F.coalesce(F.sum(f"_bs_{c}").over(w_b), F.lit(0)).alias(f"_os_{c}") for c in sums],
    )
    added = ["_on", *[f"_os_{c}" for c in sums]]
    same = F.col("d._b") == F.col("o._b")
    for c in by:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"o.{c}"))
    out = d.alias("d").join(off.alias("o"), same, "inner").select("d.*", *[f"o.{c}" for c in added])
    out = out.withColumn(rank_col, (F.col("_lr") + F.col("_on")).cast("bigint"))
    for c in sums:
        out = out.withColumn(f"{cum_prefix}{c}", F.col(f"_lc_{c}") + F.col(f"_os_{c}"))
    drop = ["_b", "_lr", "_on", *[f"_lc_{c}" for c in sums], *[f"_os_{c}" for c in sums]]
    return out.drop(*drop)


def consecutive_codes(df: DataFrame, order: list[Column | str], by: list[str] = (), code_col: str = "code",
                      s: Settings = DEFAULT) -> DataFrame:
    """0-based consecutive codes in ``order`` within ``by`` (first-appearance label codes)."""
    out = ordered_prefix(df, order, by=by, rank_col="_rank", s=s)
    return out.withColumn(code_col, (F.col("_rank") - 1).cast("int")).drop("_rank")
