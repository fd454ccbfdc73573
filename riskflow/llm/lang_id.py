"""Language ID by rank-order profiles.

A text's letters, lower-cased, with every run of other characters as one blank, give its n-grams of 1 to 3 characters
(none inside a blank run). A language's profile is its most frequent n-grams over all its training documents, by rank;
a document's profile is made alike from its whole text. The out-of-place distance sums how far each of the document's
n-grams is from its rank in the language's profile (absent ones count as the profile's size); the nearest language wins.

Defined results: a null or empty text, or one without a letter, is ``und`` with score 0; ties between n-grams go to the
smaller code points, ties between languages to the smaller name; rows with a null language do not train; repeated rows
train and are predicted each on their own; without training rows everything is ``und``; other columns are ignored by
``predict`` and kept by ``keep_known``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import sorted_counts, stage

PROFILE = 300
MAX_LANGUAGES = 10_000  # more are refused, so that the profiles which go to every task have a known bound
UNKNOWN = "und"
_BITS = np.int64(21)


def _letters() -> np.ndarray:
    """Per code point: its lower-case letter, or a blank."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def grams(text: str | None, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text's distinct n-grams, as packed code points in ascending order, and their counts."""
    cp = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    x = np.empty(len(cp) + 2, np.int64)
    x[0] = x[-1] = 32
    x[1:-1] = table[cp]
    blank = x == 32
    x = x[np.r_[True, ~(blank[1:] & blank[:-1])]]  # a run of blanks is one
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = x[:-1] << _BITS | x[1:]
    three = two[:-1] << _BITS | x[2:]
    return sorted_counts(np.concatenate([x[x != 32], two, three[x[1:-1] != 32]]))


def top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams in order of rank; equal counts by code."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def profiles(docs: DataFrame, train: Column, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Each language's profile, from every document for which ``train`` holds and whose language is known.

    Counted per batch and language in the tasks, summed by Spark; only ``size`` n-grams per language come back.
    """
    def run(batches):
        table = _letters()
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1)
            for lang in sorted(set(langs)):
                parts, held = [], 0
                sums: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
                for r in [*np.flatnonzero(langs == lang), None]:
                    if r is not None:
                        parts.append(grams(texts[int(r)].as_py(), table))
                        held += len(parts[-1][0])
                    if parts and (r is None or held > 500_000):
                        sums, parts, held = _merged([sums, *parts]), [], 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(sums[0]), pa.string()), pa.array(sums[0]), pa.array(sums[1])],
                    ["lang", "gram", "n"])

    n = (docs.filter(train & F.col("lang").isNotNull()).select("lang", "text")
         .mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    n = stage(n, "lang-grams")
    langs = n.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {}
    for r in sorted(x["lang"] for x in langs):
        rows = (n.filter(F.col("lang") == r).orderBy(F.desc("n"), "gram").limit(size).select("gram").collect())
        out[r] = np.array([x["gram"] for x in rows], np.int64)
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    at = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[at], np.add.reduceat(counts, at) if len(at) else counts


class Judge:
    """Nearest profile of a text; ``score`` is 1 less the distance's share of the largest possible one."""

    def __init__(self, known: dict[str, np.ndarray], size: int = PROFILE):
        self.names, self.size, self.table = sorted(known), size, _letters()
        codes = [known[n] for n in self.names]
        self.codes = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
        self.ranks = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)  # the last column: in no profile
        for k, c in enumerate(codes):
            self.ranks[k, np.searchsorted(self.codes, c)] = np.arange(len(c))

    def __call__(self, text: str | None) -> tuple[str, float]:
        own = top(*grams(text, self.table), self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == own, at, len(self.codes)) if len(self.codes) else at
        ranks = self.ranks[:, at]
        away = np.where(ranks >= 0, np.abs(ranks - np.arange(len(own))), self.size).sum(axis=1)
        best = int(np.argmin(away))
        return self.names[best], float(1 - away[best] / (self.size * len(own)))


def predict(docs: DataFrame, known: dict[str, np.ndarray], *more: Column, size: int = PROFILE) -> DataFrame:
    """The columns ``more`` with lang_pred and score from the whole text."""
    names = [f"c{i}" for i in range(len(more))]
    sent = docs.select(F.col("text"), *[c.alias(n) for c, n in zip(more, names)])
    kinds = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, sent.schema.fields[1:])]

    def run(batches):
        judge = Judge(known, size)
        for batch in batches:
            got = [judge(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], [*names, "lang_pred", "score"])

    return sent.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))


def keep_known(docs: DataFrame, min_score: float = 0.0, train: Column | None = None) -> DataFrame:
    """All columns of the documents whose text has a language: not ``und``, a score above 0 (some n-gram in common with the
    profile) and of ``min_score`` or more.

    The profiles are learned from the given documents with a language name. Without any, all documents with a letter stay.
    """
    known = profiles(docs, F.lit(True) if train is None else train)

    def lettered():
        table = _letters()
        return lambda text: len(grams(text, table)[0]) > 0

    def named():
        judge = Judge(known)

        def good(text):
            lang, score = judge(text)
            return lang != UNKNOWN and score > 0 and score >= min_score

        return good

    return _where(docs, named if known else lettered)


def _where(docs: DataFrame, make) -> DataFrame:
    """The rows whose text passes the test that ``make`` gives to each task; a batch is filtered as it came, with no copy of
    its texts beside it."""
    def run(batches):
        test = make()
        for b in batches:
            yield b.filter(pa.array([test(t.as_py()) for t in b.column("text")], pa.bool_()))

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns]).mapInArrow(run, docs.schema)
