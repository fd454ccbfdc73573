"""Repeated passages against a count of all windows; the query itself is held against SQL in test_llm_oracles."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.llm import substring_dedup
from riskflow.llm.queries import QUERIES


def words(text):
    return [x.decode() for x in (text or "").encode().split()]


def brute(texts, window=35):
    """(words, kept words) of every text."""
    all_ = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in all_ for i in range(len(w) - window + 1))
    out = []
    for w in all_:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check(spark, texts, window=35, ids=None):
    ids = ids or list(range(len(texts)))
    docs = spark.createDataFrame([(i, k, t, "x") for k, (i, t) in enumerate(zip(ids, texts))],
                                 "doc_id long, row long, text string, kept string").repartition(4)
    got = {r.c1: r for r in substring_dedup.remove_repeats(docs, F.col("doc_id"), F.col("row"), window=window).collect()}
    assert len(got) == len(texts)
    for k, (n, kept) in enumerate(brute(texts, window)):
        assert (got[k].n_words, got[k].kept) == (n, kept), k
        assert got[k].n_removed == n - len(kept.split())
    return got


def test_cover():
    p, cover = substring_dedup.PERIOD, set(substring_dedup.COVER)
    assert all(any((i + d) % p in cover and (j + d) % p in cover for d in range(p)) for i in range(p) for j in range(p))


def test_planted_passages(spark):
    r = random.Random(3)
    fresh = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    passages = [fresh(n) for n in (30, 34, 35, 36, 50, 80, 200)]
    texts = []
    for _ in range(60):
        w = fresh(r.randrange(60))
        for _ in range(r.randrange(4)):
            p = r.choice(passages)
            cut = r.randrange(len(p)) if r.random() < 0.3 else 0
            w += p[cut:] + fresh(r.randrange(1, 40))
        texts.append(r.choice([" ", "\n", " \t "]).join(w))
    texts += texts[:5] + ["  " + texts[0].replace(" ", "\r\n")]
    texts += [" ".join(["a"] * n) for n in (34, 35, 36, 300)]  # a text repeats itself
    texts += [" ".join(passages[6] + fresh(2) + passages[6]), None, "", " \t\n", "é" * 50, texts[3].upper()]
    got = check(spark, texts)
    assert sum(x.n_removed for x in got.values()) > 1000


def test_hot_passage_and_equal_rows(spark):
    r = random.Random(4)
    hot = " ".join(f"h{i}" for i in range(60))
    texts = [f"{' '.join(str(r.random()) for _ in range(8))} {hot} {r.random()}" for _ in range(300)]
    texts += [" ".join(f"t{i}" for i in range(70))] * 40
    check(spark, texts, ids=[None] * 300 + [7] * 40)


@pytest.mark.parametrize("window", [24, 50])
def test_other_windows(spark, window):
    r = random.Random(window)
    base = [str(r.randrange(50)) for _ in range(400)]
    texts = [" ".join(base[r.randrange(300):][: r.randrange(20, 120)]) for _ in range(60)]
    check(spark, texts, window)


def test_without_broadcast_of_keys(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MAX_KEYS", 0)
    check(spark, [" ".join(map(str, range(k, k + 60))) for k in range(0, 200, 7)] + [None, "a"])


def test_one_copy_of_a_text_with_another_key_is_untouched(spark):
    """Lists under a shared key: places that are not of this text are dropped."""
    t = " ".join(map(str, range(100)))
    check(spark, [t, t + " end", " ".join(map(str, range(200, 290)))])


def test_long_text(spark):
    w = [f"x{i}" for i in range(150_000)]
    got = check(spark, [" ".join(w), " ".join(w[70_000:70_040])])
    assert got[0].n_removed == 40


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op11_substring_dedup"](spark, str(tmp_path)).collect() == []
