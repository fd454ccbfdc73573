"""Document fingerprints from closed syncmers, in SQL functions only.

A text is read as tokens: maximal runs of characters other than ASCII white space, in pieces of at most ``PIECE`` code
points. A k-mer is ``K`` consecutive tokens, its inner substrings are the s-mers of ``S`` tokens, ordered by hash. A k-mer
is an anchor if its smallest s-mer is its first or its last one. Whether it is one depends on nothing outside it, so an
edit elsewhere moves no anchor. The fingerprint is a digest of all anchors of the whole text with their positions; likeness is
the share of common ones among all distinct anchor hashes of both texts.

``anchors`` gives all anchors with their positions, ``aligned`` matches those of two sets of texts by hash and reports
where runs of anchors agree on one offset.

Defined results: a null text is empty; a text without tokens has the empty fingerprint, one without anchors (a short one)
has the hash of all its tokens as its only anchor; two texts without tokens have likeness 1; a null id is last in descending
order; rows with equal ids follow each other by text, descending; the next of the last row is the first, the next of a
single row is itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import small, stage

PIECE, K, S = 3, 4, 2
ROWS_PER_RANGE = 4_000


def let(x: Column, f) -> Column:
    """f of x, with x computed once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]{1,%d}" % PIECE), F.lit(0))


def _anchors_of(h: Column, make) -> Column:
    """make(i) for the starts i of the closed syncmers of s-mer hashes h (at least K - S + 1 of them)."""
    last = K - S

    def is_anchor(i):
        inner = [F.get(h, i + d) for d in range(1, last)]
        first, end = F.get(h, i), F.get(h, i + last)
        return (first <= F.least(*inner, end)) | (end < F.least(first, *inner))

    starts = F.sequence(F.lit(0), F.size(h) - last - 1)
    return F.transform(F.filter(starts, is_anchor), make)


def _smers(t: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(t) - S), lambda i: F.xxhash64(*[F.get(t, i + d) for d in range(S)]))


def _kmer(h: Column, i: Column) -> Column:
    """A hash of the K tokens from i, from s-mers that cover them."""
    return F.xxhash64(*[F.get(h, i + d) for d in [*range(0, K - S, S), K - S]])


def _whole(t: Column) -> Column:
    return F.xxhash64(F.array_join(t, " "))


def sketch(text: Column) -> Column:
    """All anchors (position, hash), by position."""
    anchor = lambda i, h: F.struct(i.alias("position"), h.alias("hash"))
    none = F.array().cast("array<struct<position: int, hash: bigint>>")

    def of(t):
        found = let(_smers(t), lambda h: _anchors_of(h, lambda i: anchor(i, _kmer(h, i))))
        some = F.when(F.size(t) >= K, found).otherwise(none)
        some = let(some, lambda a: F.when(F.size(a) > 0, a).otherwise(F.array(anchor(F.lit(0), _whole(t)))))
        return F.when(F.size(t) == 0, none).otherwise(some)

    return let(tokens(text), of)


def fingerprint(s: Column) -> Column:
    """A digest of all anchors with their positions, in hex; empty without any."""
    said = F.array_join(F.transform(s, lambda x: F.concat(x["position"].cast("string"), F.lit(":"), F.hex(x["hash"]))), ",")
    return F.when(F.size(s) == 0, F.lit("")).otherwise(F.sha2(said.cast("binary"), 256))


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all distinct hashes of both sketches."""
    hashes = lambda s: F.array_distinct(F.transform(s, lambda x: x["hash"]))

    def share(x, y):
        common = F.size(F.array_intersect(x, y))
        return common / (F.size(x) + F.size(y) - common)

    both = let(hashes(a), lambda x: let(hashes(b), lambda y: share(x, y)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both).cast("double")


def with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(doc_id, text) of every row and next_text of the row after it by descending id.

    Rows are cut into ranges of ids at approximate quantiles; each range's first row is also sent, marked, to the range
    before it, so the neighbour is found inside ranges and no task sees more than one range.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = base.count()
    ranges = max(1, math.ceil(n / rows_per_range))
    probs = [i / ranges for i in range(1, ranges)]
    cuts = base.agg(F.percentile_approx(F.col("doc_id").cast("double"), probs, max(10_000, 10 * ranges)).alias("q")).first()[
        "q"] if probs else []
    splits = [-math.inf, *sorted(set(cuts or [])), math.inf]
    if len(splits) == 2:
        splits = [-math.inf, 0.0, math.inf]
    # a null id is below all others
    base = base.withColumn("_x", F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf)))
    base = Bucketizer(splits=splits, inputCol="_x", outputCol="_r", handleInvalid="keep").transform(base).drop("_x")
    base = base.withColumn("_r", F.when(F.col("doc_id").isNull(), F.lit(-1.0)).otherwise(F.col("_r")))
    tops = base.groupBy("_r").agg(F.max("doc_id").alias("top"))
    order = Window.orderBy(F.desc("_r"))
    tops = stage(tops.select("_r", "top", F.lag("_r").over(order).alias("to"),
                             F.min("_r").over(Window.partitionBy()).alias("lowest")), "range-tops")
    heads = base.alias("b").join(small(tops).alias("t"), F.expr("b._r = t._r and b.doc_id <=> t.top"))
    heads = stage(heads.select("b.doc_id", "b.text", "b._r", "t.to", "t.lowest").groupBy("_r", "to", "lowest").agg(
        F.max(F.struct("doc_id", "text")).alias("x")).select(
        "x.doc_id", "x.text", F.coalesce("to", "lowest").alias("_r"), F.col("to").isNull().cast("int").alias("_m")),
        "range-heads")
    heads = heads.withColumn("_m", F.col("_m") + 1)
    rows = base.select("doc_id", "text", "_r", F.lit(0).alias("_m")).unionByName(heads.select("doc_id", "text", "_r", "_m"))
    w = Window.partitionBy("_r").orderBy("_m", F.desc_nulls_last("doc_id"), F.desc("text"))
    rows = rows.withColumn("next_text", F.lead("text").over(w))
    return rows.filter("_m = 0").drop("_r", "_m")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The edited text has its last third replaced by the beginning of the next text.
    """
    d = with_next(docs).withColumn("n", F.length("text"))
    third = F.floor(F.col("n") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n") - third),
                      F.substring(F.col("next_text"), F.lit(1), third))
    d = d.select("doc_id", "n", sketch(F.col("text")).alias("sketch"), sketch(F.col("next_text")).alias("next_sketch"),
                 edited.alias("edited"))
    d = d.withColumn("edited_sketch", sketch(F.col("edited")))
    return d.select("doc_id", F.col("n").cast("bigint").alias("n_chars"),
                    F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    fingerprint(F.col("sketch")).alias("fingerprint"),
                    fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
                    likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, position, hash) of every anchor of every text; positions count tokens from 0."""
    d = docs.select("doc_id", F.explode(sketch(F.coalesce("text", F.lit("")))).alias("x"))
    return d.select("doc_id", "x.position", "x.hash")


def aligned(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """For given pairs (a, b) of ids: offset, matches, first and last position in a, by offset between the anchors.

    Only the stated pairs are compared; a hash that recurs in a text is matched at its first position.
    """
    first = lambda d, k: d.groupBy("doc_id", "hash").agg(F.min("position").alias(f"at_{k}")).withColumnRenamed(
        "doc_id", k)
    d = pairs.join(first(left, "a"), "a").join(first(right, "b"), ["b", "hash"])
    return d.withColumn("offset", F.col("at_b") - F.col("at_a")).groupBy("a", "b", "offset").agg(
        F.count(F.lit(1)).alias("matches"), F.min("at_a").alias("first"), F.max("at_a").alias("last"))
