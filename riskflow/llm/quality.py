"""Quality and toxicity by hierarchical empirical Bayes.

Evidence: words, the stems of longer ones (their first bytes), word shapes (letters, digits and marks as classes, runs as
one) and two measures of repetition in steps (the share of words that repeat the one before, and the share of distinct
words by length) are hashed to ``2**BITS`` features. Over all labelled documents Spark counts in how many documents of each
class a feature occurs; up to ``KEPT`` features are kept, those with the largest likelihood ratio statistics above ``Z``
squared. A ridge logistic regression on them, fitted on at most ``FIT_ROWS`` labelled documents (those with the smallest
hashes of their id), gives every document a log likelihood ratio.

Levels: with m the global rate, a host's rate is (sum of its documents' probabilities + a m) / (documents + a) and a path's
rate shrinks alike towards its host's, so sparse sites stay near the level above. a is the variance of a document's
probability inside a group over the variance between the groups' means, both estimated by moments at each level. A
document's posterior joins its likelihood ratio with its path's rate as the prior, from which its own probability is left
out. All levels are grouped sums with partial aggregation; a host may hold any share of the rows.

Defined results: a null or empty text has no features and takes its path's rate; null labels do not train; repeated label
rows count as one (the larger label), repeated documents each; without both classes among the labels the evidence is 0
and the rate is the labels' mean (one half without labels); null host or path are groups of their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import WordHash, mix64, row_slices, small, stage, utf8, word_spans

BITS = 18
Z = 4.5
KEPT = 400
SLICE = 1 << 20    # bytes of text whose features are hashed at once
FIT_ROWS = 10_000  # labelled documents of the regression, a bound; the features are chosen over all of them
STEMS = (4, 5, 6, 7)
LIMIT = 30.0       # bound of a log likelihood ratio
NEVER, LEAST_STRENGTH = 1e6, 0.1  # bounds of the pseudo-documents of the level above
_HASH = WordHash(6)


def _shape_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[ord("a"): ord("z") + 1] = ord("a")
    t[ord("A"): ord("Z") + 1] = ord("a")
    t[128:] = ord("a")
    t[ord("0"): ord("9") + 1] = ord("0")
    return t


_SHAPE = _shape_table()
_MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])  # what is in no word


def _repetition(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashed steps of both measures of repetition, two for each row with words."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n = np.bincount(row)
    have = np.flatnonzero(n)
    again = np.bincount(row[1:][(words[1:] == words[:-1]) & (row[1:] == row[:-1])], minlength=len(n))
    order = np.lexsort((words, row))
    w, r = words[order], row[order]
    distinct = np.bincount(r[np.r_[True, (w[1:] != w[:-1]) | (r[1:] != r[:-1])]], minlength=len(n))
    adjacent = np.ceil(10 * again[have] / n[have]).astype(np.uint64)
    share = np.floor(10 * distinct[have] / n[have]).astype(np.uint64)
    length = np.minimum(np.log2(n[have]).astype(np.uint64), np.uint64(15))
    keys = [mix64(np.uint64(1000) + adjacent), mix64(np.uint64(2000) + np.uint64(16) * length + share)]
    return np.r_[have, have], np.concatenate(keys)


def features(batch: pa.RecordBatch, text: str):
    """Per row the sorted distinct features of its whole text."""
    shape_hash = WordHash(66)
    for part in row_slices(batch, text, SLICE):
        data, off = utf8(part.column(text))
        starts, ends, row = word_spans(data, off)
        if len(starts):
            shape = _SHAPE[data]
            new = np.r_[True, shape[1:] != shape[:-1]]
            new[starts] = True
            kept = np.cumsum(new)  # positions among the shortened bytes
            short = shape[new]
            shapes = shape_hash(short, kept[starts] - 1, kept[ends - 1])
            w_starts, w_ends, w_row = word_spans(data, off, _MARKS)
            stems = [np.flatnonzero(w_ends - w_starts > n) for n in STEMS]
            spans = _HASH(data, np.concatenate([w_starts, *[w_starts[i] for i in stems]]),
                          np.concatenate([w_ends, *[w_starts[i] + n for i, n in zip(stems, STEMS)]]))
            own, measures = _repetition(spans[: len(w_row)], w_row)
            spans[len(w_row):] = mix64(spans[len(w_row):])  # a stem is not the word of the same letters
            keys = np.concatenate([spans, shapes, measures]) >> np.uint64(64 - BITS)
            row = np.concatenate([w_row, *[w_row[i] for i in stems], row, own])
        else:
            keys = np.zeros(0, np.uint64)
        packed = np.sort((row.astype(np.uint64) << np.uint64(BITS)) | keys)
        packed = packed[np.r_[True, packed[1:] != packed[:-1]]] if len(packed) else packed
        at = np.searchsorted(packed >> np.uint64(BITS), np.arange(part.num_rows + 1))
        own = (packed & np.uint64((1 << BITS) - 1)).astype(np.int64)
        for r in range(part.num_rows):
            yield own[at[r]: at[r + 1]]


def selected(labelled: DataFrame, targets: list[str]) -> list[np.ndarray]:
    """Per target the kept features, ascending; none where the labels have one class only."""
    def run(batches):
        for b in batches:
            marks = [np.array([-1 if v is None else int(v) for v in b.column(t).to_pylist()]) for t in targets]
            rows = list(features(b, "text"))
            for k, mark in enumerate(marks):
                for label in (0, 1):
                    own = [rows[r] for r in np.flatnonzero(mark == label)]
                    if own:
                        f, n = np.unique(np.concatenate([np.array([1 << BITS] * len(own)), *own]), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([2 * k + label] * len(f), pa.int32()), pa.array(f, pa.int32()),
                             pa.array(n, pa.int64())], ["c", "f", "n"])

    counts = stage(labelled.select("text", *targets).mapInArrow(run, "c int, f int, n long")
                   .groupBy("c", "f").agg(F.sum("n").alias("n")), "feature-counts")
    total = {r["c"]: r["n"] for r in counts.filter(F.col("f") == 1 << BITS).collect()}  # one row per target and class
    out = []
    for k in range(len(targets)):
        n0, n1 = total.get(2 * k, 0), total.get(2 * k + 1, 0)
        if not n0 or not n1:
            out.append(np.zeros(0, np.int64))
            continue
        by = counts.filter((F.col("f") < 1 << BITS) & (F.floor(F.col("c") / 2) == k)).groupBy("f").agg(
            *[F.coalesce(F.sum(F.when(F.col("c") % 2 == y, F.col("n"))), F.lit(0)).alias(f"n{y}") for y in (0, 1)])
        share = (F.col("n0") + F.col("n1")) / (n0 + n1)
        ratio = sum(F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (share * n))).otherwise(0.0)
                    for c, n in (("n0", n0), ("n1", n1))) * 2
        best = by.select("f", ratio.alias("ratio")).filter(F.col("ratio") > Z * Z).orderBy(F.desc("ratio"), "f").limit(KEPT)
        out.append(np.array(sorted(r["f"] for r in best.collect()), np.int64))
    return out


def ridge(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the last column of x is the constant, which is not penalised."""
    w, free = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    free[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -LIMIT, LIMIT)))
        curved = (x * (p * (1 - p))[:, None].astype(x.dtype)).T @ x
        step = np.linalg.solve(curved + np.diag(free), x.T @ (y - p) - free * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-5:
            break
    return w


def _logit(rate: float) -> float:
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    return math.log(rate / (1 - rate))


def fitted(labelled: DataFrame, targets: list[str]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per target the kept features, their weights and the constant of the log likelihood ratio."""
    kept = selected(labelled, targets)
    every = np.unique(np.concatenate(kept))
    n = labelled.count()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, FIT_ROWS / max(n, 1)))

    def run(batches):
        for b in batches:
            own = [np.flatnonzero(np.isin(every, f, assume_unique=True)).tolist() for f in features(b, "text")]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(own, pa.list_(pa.int32()))], [*targets, "own"])

    rows = (labelled.filter(part).select("text", *[F.col(t).cast("int").alias(t) for t in targets])
            .mapInArrow(run, ", ".join([*[f"{t} int" for t in targets], "own array<int>"])).limit(2 * FIT_ROWS).collect())
    out = []
    for t, f in zip(targets, kept):
        have = [r for r in rows if r[t] is not None]
        y = np.array([r[t] for r in have], np.float64)
        if not len(f) or not 0 < y.sum() < len(y):
            out.append((f[:0], np.zeros(0), 0.0))
            continue
        place = np.full(len(every) + 1, -1)
        place[np.searchsorted(every, f)] = np.arange(len(f))
        x = np.zeros((len(have), len(f) + 1), np.float32)
        x[:, -1] = 1
        for k, r in enumerate(have):
            at = place[np.array(r["own"], np.int64)]
            x[k, at[at >= 0]] = 1
        w = ridge(x, y)
        out.append((f, w[:-1], float(w[-1] - _logit(y.mean()))))
    return out


def evidence(docs: DataFrame, model: list[tuple[np.ndarray, np.ndarray, float]], *more: Column) -> DataFrame:
    """The columns ``more`` with e0, e1, ...: the log likelihood ratio for each target; 0 for a text without features."""
    names = [f"c{i}" for i in range(len(more))]
    sent = docs.select("text", *[c.alias(n) for c, n in zip(more, names)])
    kinds = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, sent.schema.fields[1:])]

    def run(batches):
        table = np.zeros((len(model), 1 << BITS))
        for k, (f, w, _) in enumerate(model):
            table[k, f] = w
        constant = np.array([c for _, _, c in model])
        for b in batches:
            got = [table[:, f].sum(axis=1) + constant if len(f) else np.zeros(len(model)) for f in features(b, "text")]
            got = np.clip(np.array(got).reshape(b.num_rows, len(model)), -LIMIT, LIMIT)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *[pa.array(got[:, k]) for k in range(len(model))]],
                                             [*names, *[f"e{k}" for k in range(len(model))]])

    return sent.mapInArrow(run, ", ".join([*kinds, *[f"e{k} double" for k in range(len(model))]]))


def strength(groups: DataFrame, within: float, size: str, rate: str, above: Column) -> float:
    """Pseudo-documents of the level above, within / between, by moments: a group's mean probability varies around the level above
    (``above``) by the variance between groups plus the variance ``within`` of a document divided by the group's size.

    As many as ``NEVER`` where the means vary no more than single documents explain. ``degrees`` of the rows is 1 over the number of
    groups that share a mean above, so its sum is the number of means that were fitted."""
    r = groups.agg(
        F.sum(size).alias("n"), F.count(F.lit(1)).alias("k"), F.sum("degrees").alias("fitted"),
        F.sum(F.col(size) * (F.col(rate) - above) * (F.col(rate) - above)).alias("q"),
        F.sum(F.col(size) * F.col(size) / F.col("size_above")).alias("lost")).first()
    free = float(r["k"] or 0) - float(r["fitted"] or 0)
    if free < 0.5 or within <= 0:
        return NEVER
    between = (float(r["q"]) - free * within) / max(float(r["n"]) - float(r["lost"]), 1e-9)
    return min(NEVER, max(LEAST_STRENGTH, within / between)) if between > 0 else NEVER


def levels(d: DataFrame, k: int) -> tuple[DataFrame, dict]:
    """Sums of p<k> by path (c1, c2) and host with the estimated strengths and the global mean."""
    p = F.col(f"p{k}")
    paths = stage(d.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("q")), "paths")
    hosts = paths.groupBy("c1").agg(F.sum("n").alias("hn"), F.sum("s").alias("h"), F.sum("q").alias("hq"), F.count(F.lit(1)).alias("paths"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("h").alias("s"), F.sum(F.col("hq") - F.col("h") * F.col("h") / F.col("hn")).alias("w"),
                      F.count(F.lit(1)).alias("k")).first()
    inner = paths.agg(F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("w"), F.count(F.lit(1)).alias("k")).first()
    n = int(total["n"] or 0)
    m = float(total["s"] or 0.0) / max(n, 1)
    level = stage(paths.alias("p").join(hosts.alias("h"), F.expr("p.c1 <=> h.c1")).select("p.c1", "p.c2", "n", "s", "hn", "h", "paths"),
                  "levels")
    host_rows = hosts.withColumn("degrees", F.lit(1.0 / max(int(total["k"]), 1))).withColumn("size_above", F.lit(float(max(n, 1))))
    a_host = strength(host_rows.withColumn("r", F.col("h") / F.col("hn")), float(total["w"] or 0) / max(n - total["k"], 1), "hn", "r", F.lit(m))
    path_rows = level.withColumn("degrees", 1 / F.col("paths")).withColumn("size_above", F.col("hn"))
    a_path = strength(path_rows.withColumn("r", F.col("s") / F.col("n")), float(inner["w"] or 0) / max(n - inner["k"], 1), "n", "r",
                      F.col("h") / F.col("hn"))
    return level.drop("paths"), {"m": m, "host": a_host, "path": a_path}


def posterior(d: DataFrame, rates: list[float], targets: list[str]) -> DataFrame:
    """p_<target> of the rows (c1 host, c2 path, e0, e1, ...): the likelihood ratio on the rate of the row's path.

    The row's own probability is taken out of its path's and its host's sums first, so its evidence counts once."""
    for k, t in enumerate(targets):
        d = d.withColumn(f"p{k}", 1 / (1 + F.exp(-(F.col(f"e{k}") + _logit(rates[k])))))
        level, a = levels(d, k)
        d = d.alias("d").join(small(level).alias("v"), F.expr("d.c1 <=> v.c1 and d.c2 <=> v.c2")).select("d.*", "n", "s", "hn", "h")
        own = F.col(f"p{k}")
        on_host = (F.col("h") - own + a["host"] * a["m"]) / (F.col("hn") - 1 + a["host"])
        rate = (F.col("s") - own + a["path"] * on_host) / (F.col("n") - 1 + a["path"])
        rate = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), rate))
        d = d.withColumn(f"p_{t}", 1 / (1 + F.exp(-(F.col(f"e{k}") + F.log(rate / (1 - rate)))))).drop("n", "s", "hn", "h")
    return d


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, p_quality, p_toxic, kept (quality at least as likely as not, toxicity less likely than not)."""
    targets = ["quality", "toxic"]
    marks = stage(labels.groupBy("doc_id").agg(*[F.max(t).alias(t) for t in targets]).filter("doc_id is not null"), "labels")
    labelled = docs.select("doc_id", "text").join(small(marks), "doc_id")
    rates = marks.agg(*[F.avg(t).alias(t) for t in targets]).first()
    rates = [0.5 if rates[t] is None else float(rates[t]) for t in targets]
    model = fitted(labelled, targets)
    d = stage(evidence(docs, model, F.col("doc_id"), host, path).withColumnRenamed("c0", "doc_id"), "evidence")
    d = posterior(d, rates, targets)
    return d.select("doc_id", "p_quality", "p_toxic", F.expr("p_quality >= 0.5 and p_toxic < 0.5").alias("kept"))
