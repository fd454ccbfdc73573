"""Phrase collocations of 2 to 4 words per language, from stripes.

Texts are split into pieces and those into words; a word's id is a 64-bit hash of its language and its lower-cased bytes. A
stripe belongs to a prefix and counts the words that follow it (0: the piece ends). Tasks count stripes of their texts,
the shuffle merges them element by element. One structure then gives the extensions (elements of ``min_count`` or more are
the frequent pairs), the prefix totals (a word's occurrences are the sum of its stripe; the empty prefix of a language sums
to all its words) and the largest longer phrase around each phrase. A stripe is split into ``SHARDS`` by the following word,
so that a word with a third of all occurrences is spread over tasks. Longer prefixes are counted in a second pass, only where
all pairs inside are frequent, as every part of a frequent phrase is: while the frequent pairs are at most ``MAX_PAIRS``
(8 bytes each) all tasks get them, beyond that every longer phrase is counted; the results are equal. A position gives three
words and the next in one row, so that rows stay below the words as more pairs become frequent. A last pass finds the words of
the ids that are left.

A candidate's score is floor(2000000 a / (l + r)) of its lowest cut (ties: the shorter first part), in decimals, so exact.
Candidates inside a longer one with at least ``share`` percent of their occurrences go.

Defined results: a null text is empty; a null language is ``und``, also beside a language of that name; equal rows count each;
ties in the ranking go to the phrase's byte order; an empty table, or one without a phrase of ``min_count`` occurrences, gives an
empty result; very long texts are counted whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import WordHash, mix64, row_slices, stage, utf8, word_spans

SLICE = 1 << 20
FLUSH = 1_000_000  # positions a task counts before it sends their stripes
SHARDS = 64
PARTS = 256  # of a language, for the ranking
MAX_PAIRS = 4_000_000
MAX_WORDS = 4_000_000
UNKNOWN = "und"

_CUTS = np.zeros(256, bool)
_CUTS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BREAKS = _CUTS.copy()
_BREAKS[[0x20, 0x09]] = True


def _salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _empty(lang: str) -> int:
    """The id of a language's empty prefix."""
    return int(mix64(np.array([_salt(lang) ^ np.uint64(0x5851F42D4C957F2D)], np.uint64)).view(np.int64)[0])


class _Words:
    """The words of a slice: ids, spans, languages of rows, and whether a word's piece goes on after it."""

    def __init__(self, part: pa.RecordBatch, word_hash: WordHash):
        self.data, off = utf8(part.column("text"))
        self.starts, self.ends, self.row = word_spans(self.data, off, _BREAKS)
        lang = part.column("lang").dictionary_encode()
        self.names = lang.dictionary.to_pylist()
        self.lang = lang.indices.to_numpy(zero_copy_only=False)[self.row]
        salts = np.array([_salt(x) for x in self.names], np.uint64)
        ids = mix64(word_hash(self.data, self.starts, self.ends) ^ salts[self.lang])
        ids[ids == 0] = 1
        self.ids = ids.view(np.int64)
        cuts = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(_CUTS[self.data], out=cuts[1:])
        self.more = np.zeros(len(ids), bool)
        self.more[:-1] = (self.row[1:] == self.row[:-1]) & (cuts[self.starts[1:]] == cuts[self.ends[:-1]])


def _pair(a, b):
    """A number for two ids, alike in numpy and in Spark's ``_PAIR``; it only preselects."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    return a ^ (b << np.uint64(31) | b >> np.uint64(33))


_PAIR = "w1 ^ (shiftleft(w2, 31) | shiftrightunsigned(w2, 33))"


def _within(x: np.ndarray, known: np.ndarray | None) -> np.ndarray:
    """Which values are in the sorted array ``known`` (None: all)."""
    if known is None:
        return np.ones(len(x), bool)
    if not len(known):
        return np.zeros(len(x), bool)
    at = np.searchsorted(known, x)
    return known[np.minimum(at, len(known) - 1)] == x


def _counted(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct tuples of the columns and their summed counts."""
    h = columns[0].view(np.uint64)
    for c in columns[1:]:
        h = mix64(h) ^ c.view(np.uint64)
    by = np.argsort(h, kind="stable")
    columns = [c[by] for c in columns]
    new = np.zeros(len(by), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(n[by], at) if len(at) else n


def _flushed(batches, find, names):
    """Batches of distinct tuples with n, from the columns and counts that ``find`` gives for each slice; about ``FLUSH`` rows
    are counted at a time."""
    word_hash, held, size = WordHash(20260302), [], 0
    for batch in batches:
        for part in row_slices(batch, "text", SLICE):
            got = find(_Words(part, word_hash))
            held.append(got)
            size += len(got[0])
            if size > FLUSH:
                yield _packed(held, names)
                held, size = [], 0
    if size:
        yield _packed(held, names)


def _packed(held, names):
    *columns, n = [np.concatenate(c) for c in zip(*held)]
    columns, n = _counted(columns, n)
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(n)], [*names, "n"])


def _stripes(words: DataFrame, min_count: int) -> DataFrame:
    """(lang, w1, shard, w2, n): of each prefix word and shard the frequent extensions and (w2 is 0) the sum of the others;
    a language is named by the id of its empty prefix."""
    def find(w):
        after = np.zeros_like(w.ids)
        after[:-1] = np.where(w.more[:-1], w.ids[1:], 0)
        # all words follow the empty prefix, too, of which only the total is of use
        empty = np.array([_empty(x) for x in w.names], np.int64)
        n = np.bincount(w.lang, minlength=len(empty))
        return (np.concatenate([empty[w.lang], empty]), np.concatenate([w.ids, empty]),
                np.concatenate([after, np.zeros_like(empty)]), np.concatenate([np.ones_like(w.ids), n]))

    posts = words.mapInArrow(lambda b: _flushed(b, find, ["lang", "w1", "w2"]), "lang long, w1 long, w2 long, n long")
    posts = posts.withColumn("shard", F.col("w2").bitwiseAND(F.lit(SHARDS - 1)).cast("int")).repartition("w1", "shard")
    merged = posts.groupBy("lang", "w1", "shard", "w2").agg(F.sum("n").alias("n"))
    often = F.when(F.col("n") >= min_count, F.col("w2")).otherwise(0)
    return merged.groupBy("lang", "w1", "shard", often.alias("w2")).agg(F.sum("n").alias("n"))


def _longer_posts(words: DataFrame, known: np.ndarray | None) -> DataFrame:
    """(w1, w2, w3, w4, n): at a word position the phrase of three words, all pairs in ``known`` (None: all), and the word that
    goes on with such a pair (0: none). One row a position at most, whatever share of the pairs is known."""
    sent = None if known is None else words.sparkSession.sparkContext.broadcast(known)

    def find(w):
        n, x = len(w.ids), w.ids
        ok = w.more.copy()
        at = np.flatnonzero(ok)
        ok[at] = _within(_pair(x[at], x[at + 1]), None if sent is None else sent.value)
        pad = np.zeros(3, bool)
        next1, next2 = np.r_[ok, pad][1: n + 1], np.r_[ok, pad][2: n + 2]
        i = np.flatnonzero(ok & next1)
        on = np.where(next2[i], x[np.minimum(i + 3, n - 1)], 0)
        return x[i], x[i + 1], x[i + 2], on, np.ones(len(i), np.int64)

    names = ["w1", "w2", "w3", "w4"]
    return words.mapInArrow(lambda b: _flushed(b, find, names), "w1 long, w2 long, w3 long, w4 long, n long")


def _longer(words: DataFrame, known: np.ndarray | None, min_count: int) -> DataFrame:
    """(w, a) of the phrases of three and four words with ``min_count`` occurrences or more; those of three words are the sums
    over what goes on, in the same tasks."""
    three = ["w1", "w2", "w3"]
    posts = _longer_posts(words, known).repartition(*three)
    d = posts.groupBy(*three, "w4").agg(F.sum("n").alias("n"))
    often = F.when((F.col("w4") != 0) & (F.col("n") >= min_count), F.struct("w4", "n"))
    d = d.groupBy(*three).agg(F.sum("n").alias("a"), F.collect_list(often).alias("on")).filter(F.col("a") >= min_count)
    longest = F.transform("on", lambda x: F.struct(F.array(*three, x["w4"]).alias("w"), x["n"].alias("a")))
    return d.select(F.inline(F.concat(F.array(F.struct(F.array(*three).alias("w"), "a")), longest)))


def _dictionary(words: DataFrame, known: np.ndarray | None) -> DataFrame:
    """(id, lang, word) of the ids in ``known`` (None: all), and of every language's empty prefix, without a word."""
    sent = None if known is None else words.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        word_hash, said = WordHash(20260302), np.zeros(0, np.int64)
        for batch in batches:
            for part in row_slices(batch, "text", SLICE):
                w = _Words(part, word_hash)
                some = np.flatnonzero(_within(w.ids, None if sent is None else sent.value))
                ids, at = np.unique(w.ids[some], return_index=True)
                new = ~np.isin(ids, said, assume_unique=True)
                ids, at = ids[new], some[at[new]]
                if sent is not None:  # bounded by what was sent
                    said = np.concatenate([said, ids])
                raw = w.data.tobytes()
                text = [raw[s:e].lower().decode() for s, e in zip(w.starts[at], w.ends[at])]  # bytes: A-Z only
                empty = [_empty(x) for x in w.names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*ids.tolist(), *empty], pa.int64()),
                     pa.array([*(w.names[k] for k in w.lang[at]), *w.names], pa.string()),
                     pa.array([*text, *[None] * len(empty)], pa.string())], ["id", "lang", "word"])

    return words.mapInArrow(run, "id long, lang string, word string").groupBy("id").agg(
        F.min("lang").alias("lang"), F.min("word").alias("word"))


def _sorted_values(df: DataFrame, limit: int, dtype) -> np.ndarray | None:
    """The one column of ``df`` in order, or None if it has more than ``limit`` rows. It comes as Arrow batches whatever the session
    says about Arrow, so the driver holds 8 bytes a value, twice while it copies, and never a Python object for one."""
    if df.count() > limit:
        return None
    table = df.toArrow()
    out, at = np.empty(table.num_rows, np.int64), 0
    for part in table.column(0).chunks:
        out[at: at + len(part)] = part.to_numpy(zero_copy_only=False)
        at += len(part)
    del table
    out = out.view(dtype)
    out.sort()
    return out


def collocations(docs: DataFrame, min_count: int = 30, share: int = 80, top: int = 2000, max_pairs: int = MAX_PAIRS,
                 max_words: int = MAX_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases (None: all).

    ``max_pairs`` and ``max_words`` bound what is sent to every task and change no result.
    """
    words = docs.select(F.coalesce("text", F.lit("")).alias("text"),
                        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    stripes = stage(_stripes(words, min_count), "stripes")
    totals = stage(stripes.groupBy("lang", "w1").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count), "stripe-totals")
    pairs = stage(stripes.filter("w2 != 0").select("w1", "w2", F.col("n").alias("a")), "pairs")
    known = _sorted_values(pairs.select(F.expr(_PAIR).alias("h")), max_pairs, np.uint64)
    longer = stage(_longer(words, known, min_count), "longer")
    del known  # stored: the driver keeps neither the pairs nor what was sent

    found = pairs.select(F.array("w1", "w2").alias("w"), "a").unionByName(longer)
    often = totals.select(F.array("w1").alias("w"), "f", "lang").unionByName(
        found.select("w", F.col("a").alias("f"), F.lit(None).cast("long").alias("lang")))
    cuts = found.select("w", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("slice(w, 1, k)")).withColumn("rest", F.expr("slice(w, k + 1, size(w) - k)"))
    cuts = cuts.join(often.select(F.col("w").alias("first"), F.col("f").alias("l"), "lang"), "first").join(
        often.select(F.col("w").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0))) div cast(l + r as decimal(20, 0))")
    best = cuts.groupBy("w", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"),
                                      F.max("lang").alias("lang"))  # the first word's

    # every phrase of two or more words inside a longer one, and the most occurrences of such a longer one
    inner = F.expr("""flatten(transform(sequence(2, size(w) - 1), m ->
        transform(sequence(1, size(w) - m + 1), s -> slice(w, s, m))))""")
    around = longer.select(F.explode(inner).alias("w"), "a").groupBy("w").agg(F.max("a").alias("most"))
    left = best.join(around, "w", "left").filter(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * share))
    left = left.select("lang", "w", "a", "x.score", "x.l", "x.r")
    order = [F.desc("score"), F.desc("a")]
    if top is not None:  # what ties with the last rank stays; first within parts, so that no task sorts a whole language
        for part in ([F.pmod(F.xxhash64("w"), F.lit(PARTS))], []):
            left = left.withColumn("_rank", F.rank().over(Window.partitionBy("lang", *part).orderBy(*order)))
            left = left.filter(F.col("_rank") <= top).drop("_rank")
    left = stage(left, "phrases")

    each = left.select("w", F.posexplode("w").alias("p", "id"))
    names = stage(_dictionary(words, _sorted_values(each.select("id").distinct(), max_words, np.int64)), "words")
    spelt = each.join(names.select("id", "word"), "id").groupBy("w").agg(F.array_sort(F.collect_list(F.struct("p", "word"))).alias("x"))
    spelt = spelt.select("w", F.array_join("x.word", " ").alias("phrase"))
    langs = names.filter("word is null").select(F.col("id").alias("lang"), F.col("lang").alias("name"))
    langs = langs.join(totals.filter("w1 = lang").select("lang", F.col("f").alias("n")), "lang")
    d = left.join(spelt, "w").join(langs, "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    d = d.withColumn("rank", rank.cast("long"))
    if top is not None:
        d = d.filter(F.col("rank") <= top)
    return d.select(F.col("name").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")
