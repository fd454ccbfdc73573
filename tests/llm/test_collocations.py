"""Phrases against counts of all word sequences; the query itself is held against SQL in test_llm_oracles."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import collocations
from riskflow.llm.queries import QUERIES

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, share, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        most = Counter()
        for g, a in found.items():
            for m in range(2, len(g)):
                for s in range(len(g) - m + 1):
                    most[g[s:s + m]] = max(most[g[s:s + m]], a)
        ranked = []
        for g, a in found.items():
            score, _, l, r = min((2_000_000 * a // (c[g[:k]] + c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
            if 100 * most[g] < share * a:
                ranked.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def texts(seed, n=400):
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "San", "é", "Éa", "x-y", " ", "10", *(f"w{i}" for i in range(30))]
    phrases = [r.choices(vocabulary, k=r.randrange(2, 7)) for _ in range(12)]
    rows = []
    for _ in range(n):
        w = []
        for _ in range(r.randrange(12)):
            w += r.choice(phrases) if r.random() < 0.5 else r.choices(vocabulary, k=3)
            if r.random() < 0.3:
                w.append(r.choice([".", ",", "\n", "\x0b", "!?"]))
        rows.append((r.choice(["en", "de", None, "und", ""]), r.choice([" ", "\t ", "  "]).join(w)))
    return rows + [("en", None), (None, ""), ("fr", "one two"), ("en", "a " * 200), ("de", "the of " * 500)]


def got(spark, rows, **kw):
    d = [(i, t, lang, "x") for i, (lang, t) in enumerate(rows)]
    docs = spark.createDataFrame(d, "doc_id long, text string, lang string, phrase string").repartition(3)
    return sorted(tuple(r) for r in collocations.collocations(docs, **kw).collect())


@pytest.mark.parametrize("seed,least,share,top", [(1, 30, 80, 2000), (2, 5, 80, 7), (3, 12, 50, 40), (4, 2, 100, None)])
def test_against_counts(spark, seed, least, share, top):
    rows = texts(seed)
    want = brute(rows, least, share, top)
    assert len(want) > 10
    assert got(spark, rows, min_count=least, share=share, top=top) == want


def test_beyond_what_is_sent_to_tasks(spark):
    rows = texts(5)
    assert got(spark, rows, min_count=8, max_pairs=0, max_words=0) == brute(rows, 8, 80, 2000)


def test_flush_and_slices(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 200)
    monkeypatch.setattr(collocations, "FLUSH", 100)
    rows = texts(6, 150)
    assert got(spark, rows, min_count=4) == brute(rows, 4, 80, 2000)


@pytest.mark.parametrize("arrow", ["false", "true"])
def test_values_reach_the_driver_without_objects(spark, arrow):
    """A few bytes a value on the driver, also in a session that does not use Arrow by itself (the default)."""
    n, key = 100_000, "spark.sql.execution.arrow.pyspark.enabled"
    df, was = spark.range(n).repartition(3).select((F.col("id") * 7 - 350_000).alias("h")), spark.conf.get(key)
    spark.conf.set(key, arrow)
    tracemalloc.start()
    try:
        got = collocations._sorted_values(df, n, np.int64)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        spark.conf.set(key, was)
    assert np.array_equal(got, np.arange(n) * 7 - 350_000) and peak < 40 * n
    assert np.array_equal(collocations._sorted_values(df, n, np.uint64), np.sort(got.view(np.uint64)))
    assert collocations._sorted_values(df, n - 1, np.int64) is None
    assert len(collocations._sorted_values(df.limit(0), n, np.uint64)) == 0


@pytest.mark.parametrize("all_pairs", [True, False])
def test_one_row_a_position(spark, all_pairs):
    rows = [("en", f"a b c d e{k} f g. h i") for k in range(50)]
    words = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    known = None if all_pairs else np.zeros(0, np.uint64)
    posts = collocations._longer_posts(words, known)
    x = posts.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.when(F.col("w4") != 0, F.col("n")))).first()
    # a b c d once, the other four beginnings in each of 50 texts; the last of them has no fourth word
    assert tuple(x) == ((1 + 4 * 50, 5 * 50, 4 * 50) if all_pairs else (0, None, None))
    found = sorted((len(w), a) for w, a in collocations._longer(words, None, 2).collect())
    assert found == [(3, 50), (3, 50), (4, 50)]


def test_three_words_that_go_on_rarely(spark):
    rows = [("en", f"of the new w{k % 7}") for k in range(28)] + [("en", "of the new")] * 3 + [("de", "x y z. of the new")] * 31
    want = brute(rows, 5, 80, 2000)
    assert any(r[2] == "of the new" and r[3] == 31 and r[0] == "en" for r in want)
    assert got(spark, rows, min_count=5) == want


def test_score_is_exact(spark):
    a = 10**14 + 7
    d = spark.createDataFrame([(a, a + 1, a + 3)], "a long, l long, r long")
    score = "(cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0))) div cast(l + r as decimal(20, 0))"
    assert d.selectExpr(score).first()[0] == 2_000_000 * a // (2 * a + 4)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "rare words only", "en")]])
def test_no_phrase(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op13_phrase_collocations"](spark, str(tmp_path)).collect() == []
