"""Periodic runs against a quadratic search."""

import hashlib
import zlib

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from riskflow.llm import periodic_runs
from riskflow.llm.queries import QUERIES


def slow_runs(w):
    """All runs by trying every period, smallest first; a stretch that a smaller period has taken stays with it."""
    seen = {}
    w = np.array([hash(x) for x in w], np.int64)
    for q in range(1, len(w) // 4 + 1):
        same = np.r_[False, w[q:] == w[:-q], False]
        edge = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edge[::2], edge[1::2] + q):
            if e - s >= max(6, 4 * q):
                seen.setdefault((int(s), int(e)), q)
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def collapsed(w, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def words(text):
    return [x.decode() for x in (text or "").encode().split()]


def sequences():
    rng = np.random.default_rng(5)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 200, list("ab" * 30), list("aab" * 9) + list("ba" * 8)]
    for k in (2, 3, 30):
        for _ in range(60):
            parts = []
            while sum(map(len, parts)) < rng.integers(1, 160):
                unit = [str(x) for x in rng.integers(0, k, rng.integers(1, 24))]
                parts.append((unit * int(rng.integers(1, 9)))[: rng.integers(1, 150)])
            out.append([x for p in parts for x in p])
    fib = ["a"], ["a", "b"]
    for _ in range(10):
        fib = fib[1], fib[1] + fib[0]
    nested = (["x"] * 7 + ["y"]) * 6
    return [*out, fib[1], nested, (nested + ["z"]) * 5, list("abcab" * 40)]


def test_hand_made_sequences(spark):
    seqs = sequences()
    rows = [(i, "  " + " \t".join(w) + "\n", "clash") for i, w in enumerate(seqs)] + [(len(seqs), None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = {r.c0: r for r in periodic_runs.collapse(docs, F.col("doc_id")).collect()}
    assert len(got) == len(rows)
    for i, w in enumerate([*seqs, []]):
        want = slow_runs(w)
        assert [(r.start, r.length, r.period) for r in got[i].runs] == want, w
        assert got[i].n_words == len(w) and got[i].collapsed == collapsed(w, want)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    assert set(got) == set(docs)
    some = 0
    for i, text in docs.items():
        w, h = words(text), zlib.crc32(str(i).encode())
        g, n = h // 10, len(words(text))
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        runs = slow_runs(w)
        r = got[i]
        some += len(runs)
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert some > 10


@pytest.mark.parametrize("rows", [[], [(None, None), (None, "a a a a a a"), (1, ""), (1, "b b b b b b b"), (1, "b b b b b b b")]])
def test_edges(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert sorted(r.n_runs for r in got) == sorted([0, 1, 0, 1, 1][: len(rows)])


def test_long_text(spark):
    w = ["x%d" % (i % 977) for i in range(60_000)] + ["y"] * 40_000
    docs = spark.createDataFrame([(1, " ".join(w))], "doc_id long, text string")
    r = periodic_runs.collapse(docs, F.col("doc_id")).first()
    assert [tuple(x) for x in r.runs] == [(0, 60_000, 977), (60_000, 40_000, 1)]
    assert r.collapsed == " ".join(w[:977] + ["y"])
