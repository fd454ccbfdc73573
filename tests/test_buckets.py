"""Order buckets that are cut again where they are large, and the sketched cardinality gate."""

import math
import random

import pandas as pd
from pyspark.sql import functions as F

from riskflow.operators import encode as E
from riskflow.operators import ordered as O
from riskflow.operators import split as SP
from riskflow.settings import DEFAULT

SMALL = DEFAULT.with_(rows_per_bucket=40, min_buckets=2)


def keyed(spark, n=6000):
    """A third without a time, a third at one time, some NaN and infinite, the rest spread."""
    rng = random.Random(5)
    special = [math.nan, math.inf, -math.inf]
    rows = [(i, None if i % 3 == 0 else 7.0 if i % 3 == 1 else special[i % 9 // 3] if i % 10 == 2 else rng.uniform(-50, 50),
             i % 2, rng.randint(0, 5)) for i in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id long, t double, g int, x long")


def place(r):
    """NULL after NaN after infinity, then the id."""
    t = r[1]
    return (2, 0.0, r[0]) if t is None else (1, 0.0, r[0]) if math.isnan(t) else (0, t, r[0])


def test_large_buckets_are_cut(spark, monkeypatch):
    monkeypatch.setattr(O, "FIRST", 8)
    rows, d = keyed(spark)
    b = O.bucketed(d, [F.col("t"), F.col("id")], SMALL)
    assert b.groupBy("_b").count().agg(F.max("count")).first()[0] <= 2 * SMALL.rows_per_bucket
    got = {r.id: r._b for r in b.select("id", "_b").collect()}
    in_order = [got[r[0]] for r in sorted(rows, key=place)]
    assert in_order == sorted(in_order) and len(rows) == len(got)


def test_equal_keys_stay_together(spark):
    d = spark.range(500).select(F.lit(1.0).alias("t"), F.lit(2).alias("id"), F.col("id").cast("string").alias("name"))
    for order in (["t", "id"], ["t", "name"], ["t"]):
        assert O.bucketed(d, [F.col(c) for c in order], SMALL).select("_b").distinct().count() == 1
    assert O.bucketed(d.limit(0), [F.col("t")], SMALL).count() == 0


def test_prefix_over_cut_buckets(spark, monkeypatch):
    monkeypatch.setattr(O, "FIRST", 8)
    rows, d = keyed(spark)
    seen, total, want = {}, {}, {}
    for i, _, g, x in sorted(rows, key=place):
        seen[g], total[g] = seen.get(g, 0) + 1, total.get(g, 0) + x
        want[i] = (seen[g], total[g])
    got = O.ordered_prefix(d, ["t", "id"], by=["g"], sums=["x"], s=SMALL).collect()
    assert {r.id: (r._rank, r.cum_x) for r in got} == want


def test_hash_ranges_match_a_plain_rank(spark):
    d = spark.range(3000).select(F.col("id").alias("TransactionID"), (F.col("id") % 7 == 0).cast("int").alias("isFraud"))
    got = SP.class_ranks(d, s=SMALL).toPandas()
    h = d.select("TransactionID", SP.hash32("TransactionID", "42").alias("h")).toPandas()
    both = got.merge(h, on="TransactionID").sort_values(["h", "TransactionID"])
    pd.testing.assert_series_equal(both["_rank"], both.groupby("isFraud").cumcount() + 1, check_names=False, check_dtype=False)


def test_sketched_gate_rules_out_ids_only(spark):
    d = spark.range(5000).select(
        F.col("id").cast("string").alias("key"), (F.col("id") % 100).cast("string").alias("full"),
        (F.col("id") % 101).cast("string").alias("over"), F.lit(None).cast("string").alias("none"),
        (F.col("id") % 3).cast("int").alias("isFraud"))
    cols = ["key", "full", "over", "none"]
    assert E.sketched_gate(d, cols) == ["full", "over", "none"]
    state, mean, gated = E.target_state(d, cols=cols)
    assert gated == ["full"] and state.count() == 100 and state.select("col").distinct().count() == 1
    out, state, mean = E.target_encode(d.select("key", "isFraud"), cols=["key"])
    assert out.columns == ["key", "isFraud"] and state.count() == 0 and mean == d.agg(F.avg("isFraud")).first()[0]
