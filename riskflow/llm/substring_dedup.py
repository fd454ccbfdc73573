"""Removal of repeated word passages, by difference-cover anchors.

A window is ``window`` consecutive words of one text. A word goes if a window over it has the same words as a window that
starts anywhere else, in the same text or in another one. Windows are judged on the input.

Residues modulo ``PERIOD`` are covered by ``COVER``: for any two starts i and j some d < PERIOD has i + d and j + d both at
covered residues. So only the covered positions of a text (5 of 21) post a hash of an anchor, the window - PERIOD + 1 words
from there, and two equal windows always share an anchor at the same place in both. Anchors that occur once are dropped.
The rest extend: every window that holds a surviving anchor posts a hash of all its words (96 bits), and windows whose hash
occurs again are repeated. Three passes over the texts; texts are shuffled only to meet their own anchors and windows, and
only those that have any while their keys are few enough to send to every task.

Within a slice of a batch, equal hashes are collapsed before the shuffle: one marker stands for them, and their own rows,
known to be repeated, travel under spread keys. So a passage that a third of all texts share is one row a slice.

Defined results: a null or empty text has no words; words are compared byte by byte, white space between them does not
count; texts shorter than a window lose nothing; rows with equal ids and equal texts are occurrences of their own, so each
repeats the other; an empty table gives an empty result; very long texts are never cut; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import WindowHash, WordHash, joined, mix64, row_slices, stage, utf8, word_spans

#: A perfect difference set, so that each non-zero residue is the difference of exactly one pair.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
SLICE = 4 << 20
MAX_KEYS = 500_000  # rows of 8 bytes that may be broadcast
_MARK = np.int64(1) << 31  # as a position: stands for equal hashes elsewhere in its slice
_LOW = 0xFFFFFFFF


class _Words:
    """The words of a slice: spans, rows, places within the row, and their hashes."""

    def __init__(self, part: pa.RecordBatch):
        self.data, self.off = utf8(part.column("_text"))
        self.starts, self.ends, self.row = word_spans(self.data, self.off)
        self.n = np.bincount(self.row, minlength=part.num_rows)
        self.first = np.cumsum(self.n) - self.n

    def hashes(self, seed: int) -> np.ndarray:
        return WordHash(seed, fold=False)(self.data, self.starts, self.ends)


def _posts(h: np.ndarray, key: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """Rows (h, g, place) of a slice; place has ``high`` above 32 bits of ``low`` (its complement where a twin is known)."""
    by = np.argsort(h, kind="stable")
    s = h[by]
    twin = s[1:] == s[:-1]
    many = np.r_[False, twin] | np.r_[twin, False]
    lead = by[many & np.r_[True, ~twin]] if len(by) else by
    one, known = by[~many], by[many]
    spread = mix64(mix64(key[known].view(np.uint64)) ^ low[known].astype(np.uint64))
    place = np.concatenate([low[one], _LOW - low[known], np.full(len(lead), _MARK)])
    above = np.concatenate([high[one], high[known], high[lead]])
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([h[one], spread, h[lead]]).view(np.int64)),
        pa.array(np.concatenate([key[one], key[known], np.zeros(len(lead), np.int64)])),
        pa.array(place | above << 32)], ["h", "g", "place"])


def _repeated(posts: DataFrame) -> DataFrame:
    """(g, places): of every text the places whose hash occurs more than once."""
    low = F.col("place").bitwiseAND(F.lit(_LOW))
    high = F.shiftrightunsigned("place", 32)
    n = F.count(F.lit(1)).over(Window.partitionBy("h", "high"))
    d = posts.select("h", "g", low.alias("low"), high.alias("high")).withColumn("n", n)
    known = F.col("low") > F.lit(int(_MARK))
    d = d.filter((F.col("low") != F.lit(int(_MARK))) & ((F.col("n") > 1) | known))
    at = F.when(known, F.lit(_LOW) - F.col("low")).otherwise(F.col("low"))
    return d.select("g", F.shiftleft("high", 32).bitwiseOR(at).alias("at")).groupBy("g").agg(
        F.collect_list("at").alias("places"))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the row of each; null lists are empty."""
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(n)), n)


def _meet(docs: DataFrame, lists: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of docs that have a list, with it, and the others; (all, None) where the keys are too many to broadcast."""
    if lists.count() > MAX_KEYS:
        return docs.join(lists, "g", "left"), None
    keys = F.broadcast(lists.select("g"))
    return docs.join(keys, "g", "left_semi").join(lists, "g"), docs.join(keys, "g", "left_anti")


def remove_repeats(docs: DataFrame, *keep: Column, window: int = 35) -> DataFrame:
    """The columns ``keep`` (c0, c1, ...) of every row with n_words, n_removed and kept (its other words, by one blank)."""
    anchor = window - PERIOD + 1
    if anchor < 4:
        raise ValueError(f"a window needs {PERIOD + 3} words or more")
    names = [f"c{i}" for i in range(len(keep))]
    base = docs.select(F.coalesce("text", F.lit("")).alias("_text"), *[c.alias(x) for c, x in zip(keep, names)])
    base = base.withColumn("g", F.xxhash64("_text", *names))
    post = "h long, g long, place long"

    def anchors(batches):
        covered = np.zeros(PERIOD, bool)
        covered[list(COVER)] = True
        for batch in batches:
            for part in row_slices(batch, "_text", SLICE):
                w = _Words(part)
                place = np.arange(len(w.row)) - w.first[w.row]
                n = w.n[w.row]
                at = np.flatnonzero(covered[place % PERIOD] & (place + anchor <= n) & (n >= window))
                h = WindowHash(w.hashes(1))(at, anchor)
                key = part.column("g").to_numpy(zero_copy_only=False)[w.row[at]]
                yield _posts(h, key, place[at], np.zeros(len(at), np.int64))

    def checks(w, at):
        return (WindowHash(w.hashes(3), 0xA0761D6478BD642F)(at, window) >> np.uint64(33)).astype(np.int64)

    def windows(batches):
        for batch in batches:
            for part in row_slices(batch, "_text", SLICE):
                w = _Words(part)
                place, row = _lists(part.column("places"))
                some = place < w.n[row]
                place, row = place[some], row[some]
                turn = np.zeros(len(w.row) + 1, np.int64)
                np.add.at(turn, w.first[row] + np.maximum(place - PERIOD + 1, 0), 1)
                np.add.at(turn, w.first[row] + np.minimum(place, w.n[row] - window) + 1, -1)
                at = np.flatnonzero(np.cumsum(turn[:-1]) > 0)
                key = part.column("g").to_numpy(zero_copy_only=False)[w.row[at]]
                yield _posts(WindowHash(w.hashes(2))(at, window), key, at - w.first[w.row[at]], checks(w, at))

    def cut(batches):
        for batch in batches:
            for part in row_slices(batch, "_text", SLICE):
                w = _Words(part)
                place, row = _lists(part.column("places"))
                check, place = place >> 32, place & _LOW
                some = place + window <= w.n[row]
                check, at = check[some], (w.first[row] + place)[some]
                at = at[checks(w, at) == check]  # a place is of this text, not of another one with the same key
                turn = np.zeros(len(w.row) + 1, np.int64)
                np.add.at(turn, at, 1)
                np.add.at(turn, at + window, -1)
                kept = np.cumsum(turn[:-1]) == 0
                text = joined(w.data, w.starts[kept], w.ends[kept], w.row[kept], part.num_rows)
                gone = w.n - np.bincount(w.row[kept], minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(x) for x in names], pa.array(w.n.astype(np.int64)), pa.array(gone.astype(np.int64)),
                     text.cast(pa.string())], [*names, "n_words", "n_removed", "kept"])

    found = stage(_repeated(base.select("g", "_text").mapInArrow(anchors, post)), "anchors")
    near, _ = _meet(base.select("g", "_text"), found)
    again = stage(_repeated(near.filter("places is not null").mapInArrow(windows, post)), "windows")
    hit, rest = _meet(base, again)
    if rest is not None:
        hit = hit.unionByName(rest.withColumn("places", F.lit(None).cast("array<long>")))
    kinds = [f"{x} {base.schema[x].dataType.simpleString()}" for x in names]
    return hit.mapInArrow(cut, ", ".join([*kinds, "n_words long, n_removed long, kept string"]))
