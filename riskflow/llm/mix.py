"""Mixing sources to target weights.

Every document gets a hash-random key from its id. Rows are range-sorted by that key within each source: the key
space is cut into equal ranges (the keys are uniform, so ranges hold like counts), a running sum inside each
(source, range) and the totals of earlier ranges give the distributed prefix sum of sizes, and the source's budget
is cut exactly where the prefix sum reaches it. A target above the source's size repeats whole epochs first.

Defined results: a null text has size 0; a null source is a source of its own, ordered last; a null id has the key
of the empty text; repeated rows are rows of their own (ties in the key are ordered by id and size, and rows equal
in those are interchangeable); an empty table gives an empty result; other columns are carried only by ``mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import WORD, stage

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2
ROWS_PER_RANGE = 20_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """(source, source_size) -> the same with ``target``: shares by weight, capped at ``limit`` times the size.

    Sources reach their cap in ascending order of cap / weight, so the last level at which the rest still gets more
    than its caps is found by one running sum over the sources. The window runs over one row per source, never over
    documents.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("w", F.element_at(F.array(*[F.lit(x) for x in weights]),
                                           ((F.row_number().over(w) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * limit)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("*", F.coalesce(F.sum("cap").over(upto), F.lit(0)).alias("cap_before"),
                 F.coalesce(F.sum("w").over(upto), F.lit(0)).alias("w_before"),
                 F.sum("source_size").over(Window.partitionBy()).alias("total"),
                 F.sum("w").over(Window.partitionBy()).alias("w_total"))
    # what a unit of weight gets if exactly the sources before this one are capped
    s = s.withColumn("rest", F.col("total") * F.lit(float(share)) - F.col("cap_before"))
    s = s.withColumn("w_rest", F.col("w_total") - F.col("w_before"))
    s = s.withColumn("capped", F.col("rest") * F.col("w") / F.col("w_rest") >= F.col("cap"))
    every = Window.partitionBy()
    free = ~F.col("capped")
    s = s.withColumn("rest_free", F.max(F.when(free, F.col("rest"))).over(every))
    s = s.withColumn("w_free", F.max(F.when(free, F.col("w_rest"))).over(every))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("rest_free") * F.col("w") / F.col("w_free"))
    return s.select("source", "source_size", target.alias("target"))


def prefix_sums(rows: DataFrame, sizes: DataFrame, n_rows: int) -> DataFrame:
    """rows (source, size, key, doc_id, ...) with the columns of ``sizes`` and ``before``: the sum of earlier sizes."""
    ranges = max(1, math.ceil(n_rows / ROWS_PER_RANGE))
    at = F.floor(F.conv(F.substring("key", 1, 6), 16, 10).cast("bigint") * ranges / F.lit(1 << 24)).cast("int")
    rows = rows.withColumn("rng", at)
    totals = rows.groupBy("source", "rng").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("source").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("source", "rng", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"))
    starts = starts.alias("x").join(sizes.alias("y"), F.expr("x.source <=> y.source")).select("x.*", *[
        f"y.{c}" for c in sizes.columns if c != "source"])
    inside = (Window.partitionBy("source", "rng").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("upto", F.sum("size").over(inside))
    out = rows.alias("a").join(starts.alias("b"), F.expr("a.source <=> b.source and a.rng = b.rng"))
    return out.select("a.*", *[f"b.{c}" for c in starts.columns if c not in ("source", "rng")]).withColumn(
        "before", F.col("start") + F.col("upto") - F.col("size")).drop("rng", "upto", "start")


def _keyed(docs: DataFrame, seed: str, *more: Column) -> DataFrame:
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return docs.select("doc_id", "source", word_count("text").alias("size"), key.alias("key"), *more)


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: str = "mix",
             *more: Column) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, epochs (whole copies), part (words of one more copy), taken.

    ``more`` are further columns to carry along. Only a source's last document in key order can have a part that is
    neither 0 nor its size.
    """
    narrow = stage(_keyed(docs, seed), "mix-sizes")
    sizes = stage(source_targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share,
                                 limit), "mix-sources")
    rows = _keyed(docs, seed, *more) if more else narrow
    d = prefix_sums(rows, sizes, narrow.count())
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    d = d.withColumn("epochs", epochs.cast("bigint"))
    rest = F.floor("target").cast("bigint") - F.col("epochs") * F.col("source_size")
    d = d.withColumn("part", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), rest - F.col("before"))))
    d = d.withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
    return d.drop("key", "before")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    A source's boundary document comes once more with just the words that its budget still takes (n_chars follows
    where it exists). Documents of which nothing is taken are left out.
    """
    plan = mix_plan(docs, settings.pop("weights", WEIGHTS), settings.pop("share", SHARE), settings.pop("limit", LIMIT),
                    settings.pop("seed", "mix"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    copies = F.expr("epochs + cast(part > 0 as int)")
    d = plan.filter("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    cut = F.expr("copy > epochs and part < size")
    lead = F.regexp_extract_all(F.col("row.text"), F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"))
    text = F.when(cut, F.array_join(F.slice(lead, F.lit(1), F.col("part").cast("int")), "")).otherwise(F.col("row.text"))
    d = d.select("row", "copy", "epochs", "part", "size", text.alias("new"))
    out = []
    for f in docs.schema.fields:
        c = F.col(f"row.`{f.name}`")
        if f.name == "text":
            c = F.col("new")
        elif f.name == "n_chars":
            c = F.when(cut, F.length("new").cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return d.select(*out)
