"""Periodic runs in word sequences, by internal pattern matching.

A run is a stretch of consecutive words with smallest period q and a length of max(6, 4q) words or more that cannot be
extended on either side with period q. Texts of a batch form one sequence in which words of different rows differ. Prefix
doubling gives, for every power of two B, the class of each substring of B words, and a suffix order in which a class is one
interval. A run with B <= q < 2B holds a block of B words at a multiple of B that occurs again q words later, in the
neighbouring window of B starts. A wavelet matrix over the suffix order answers how often and where the block's class
occurs in that window (range counts and range successors). At most two occurrences are candidate periods as they are;
three or more form an arithmetic progression with difference d, so block and progression each lie in a stretch of period d,
and only the distances between the left ends and between the right ends of the two stretches can be periods. A candidate
is extended in both directions by the substring classes, exactly; of equal stretches the smallest period stays.

Every row is judged on its own in one pass without a shuffle; memory grows with a batch slice or with the longest single
text (about 200 bytes a word), never with a group.

Defined results: a null or empty text has no words and no runs and stays empty; words are compared byte by byte; repeated
rows are judged each on their own; an empty table gives an empty result; very long texts are one sequence, never cut; other
columns are ignored, also those named as an output.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import WordHash, joined, mix64, row_slices, utf8, word_spans

SLICE = 2 << 20
MIN_WORDS, MIN_EXPONENT = 6, 4


class Classes:
    """Substring classes of lengths 1, 2, 4, ... of a sequence, and a suffix order in which every class is an interval.

    ``levels[k][i]`` is the first place in the order of the class of the 2^k values from i (a shorter rest is a class of its
    own); ``size[k]`` gives a class's size at that place.
    """

    def __init__(self, values: np.ndarray, longest: int):
        n = len(values)
        self.order = np.argsort(values, kind="stable")
        s = values[self.order]
        lo = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        many = np.diff(np.r_[lo, n])
        rank, size = np.empty(n, np.int32), np.zeros(n, np.int32)
        rank[self.order] = np.repeat(lo, many)
        size[lo] = many
        self.levels, self.size = [rank], [size]
        half = 1
        while 2 * half <= longest:
            open_ = np.flatnonzero(np.repeat(size[lo] > 1, np.diff(np.r_[lo, n])))  # places in classes of two or more
            if not len(open_):
                break
            at = self.order[open_]
            after = np.where(at + half < n, rank[np.minimum(at + half, n - 1)], -1).astype(np.int64)
            key = rank[at].astype(np.int64) * (n + 1) + after + 1
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            self.order[open_] = at
            new = np.r_[True, key[1:] != key[:-1]]
            first = open_[new]
            many = np.diff(np.r_[np.flatnonzero(new), len(at)])
            rank, size = rank.copy(), size.copy()
            rank[at] = np.repeat(first, many)
            size[first] = many
            lo = np.flatnonzero(size)
            self.levels.append(rank)
            self.size.append(size)
            half *= 2

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values from i and from j on are equal (i < j)."""
        n, k, got = len(self.order), len(self.levels) - 1, np.zeros(len(i), np.int64)
        left = np.arange(len(i))
        while k >= 0:
            r, to = self.levels[k], j[left] + got[left]
            same = (to < n) & (r[np.minimum(i[left] + got[left], n - 1)] == r[np.minimum(to, n - 1)])
            got[left[same]] += 1 << k
            if k == len(self.levels) - 1 and same.any():
                left = left[same]  # the longest class may fit again
                continue
            left = np.arange(len(i))
            k -= 1
        return got

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values before i and before j are equal (i < j)."""
        k, got = len(self.levels) - 1, np.zeros(len(i), np.int64)
        some = np.arange(len(i))
        while k >= 0:
            r, to = self.levels[k], i[some] - got[some] - (1 << k)
            same = (to >= 0) & (r[np.maximum(to, 0)] == r[np.maximum(j[some] - got[some] - (1 << k), 0)])
            got[some[same]] += 1 << k
            if k == len(self.levels) - 1 and same.any():
                some = some[same]
                continue
            some = np.arange(len(i))
            k -= 1
        return got


class WaveletMatrix:
    """Range counts and order statistics of an array of distinct numbers below its length."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(self.n - 1).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            c = np.zeros(self.n + 1, np.int32)
            np.cumsum(one, out=c[1:])
            self.ones.append(c)
            self.zeros.append(self.n - int(c[-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values at places lo..hi-1 are less than x."""
        lo, hi, got = lo.astype(np.int64), hi.astype(np.int64), np.zeros(len(lo), np.int64)
        over = x >= 1 << self.bits
        whole = hi - lo
        for k, b in enumerate(range(self.bits - 1, -1, -1)):
            c, one = self.ones[k], (x >> b) & 1 == 1
            l1, h1 = c[lo], c[hi]
            got += np.where(one, (hi - h1) - (lo - l1), 0)
            lo, hi = np.where(one, self.zeros[k] + l1, lo - l1), np.where(one, self.zeros[k] + h1, hi - h1)
        return np.where(over, whole, got)

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) at places lo..hi-1."""
        lo, hi, k, got = lo.astype(np.int64), hi.astype(np.int64), k.copy(), np.zeros(len(lo), np.int64)
        for j, b in enumerate(range(self.bits - 1, -1, -1)):
            c = self.ones[j]
            l1, h1 = c[lo], c[hi]
            none = (hi - h1) - (lo - l1)
            one = k >= none
            k = np.where(one, k - none, k)
            got |= one.astype(np.int64) << b
            lo, hi = np.where(one, self.zeros[j] + l1, lo - l1), np.where(one, self.zeros[j] + h1, hi - h1)
        return got


def find_runs(values: np.ndarray, n_words: np.ndarray, min_words: int = MIN_WORDS,
              exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) and smallest periods of all runs, by start and period.

    ``values`` is the sequence of all rows, ``n_words`` their lengths; no value may occur in two rows. ``exponent`` is 4 or
    more, as the search needs the room.
    """
    if exponent < 4:
        raise ValueError("a run needs four periods or more")
    none = np.zeros(0, np.int64)
    if not len(values) or n_words.max() < max(min_words, exponent):
        return none, none, none
    known = Classes(values, int(n_words.max()) // exponent)
    first = np.cumsum(n_words) - n_words
    at, period = [], []
    r = known.levels[0]
    at.append(np.flatnonzero(r[1:] == r[:-1]))  # a window of one start needs no search
    period.append(np.ones(len(at[0]), np.int64))
    block, lo, hi, size = [none], [none], [none], [none]
    for k in range(1, len(known.levels)):
        b = 1 << k
        able = n_words >= max(min_words, exponent * b)
        many = n_words[able] // b
        x = np.repeat(first[able], many) + b * (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        place = known.levels[k][x].astype(np.int64)
        often = known.size[k][place]
        some = often > 1
        block.append(x[some])
        lo.append(place[some])
        hi.append(place[some] + often[some])
        size.append(np.full(int(some.sum()), b, np.int64))
    block, lo, hi, size = (np.concatenate(z) for z in (block, lo, hi, size))
    if len(block):
        tree = WaveletMatrix(known.order)
        k0, k1 = tree.below(lo, hi, block + size), tree.below(lo, hi, block + 2 * size)
        some = k1 > k0
        block, lo, hi, size, k0, k1 = (z[some] for z in (block, lo, hi, size, k0, k1))
        one = tree.kth(lo, hi, k0)
        few = k1 - k0 <= 2
        at.append(block[few])
        period.append((one - block)[few])
        two = k1 - k0 >= 2
        second = tree.kth(lo[two], hi[two], k0[two] + 1)
        pair = few[two]
        at.append(block[two][pair])
        period.append((second - block[two])[pair])
        x, o, d = block[~few], one[~few], (second - one[two])[~pair]
        for edge, way in ((known.left, -1), (known.right, 1)):
            own = x + way * edge(x, x + d) + (d if way > 0 else 0)
            their = o + way * edge(o, o + d) + (d if way > 0 else 0)
            at.append(x)
            period.append(their - own)
    at, period = np.concatenate(at), np.concatenate(period)
    some = (period > 0) & (at + period < len(values))
    at, period = at[some], period[some]
    end = at + period + known.right(at, at + period)
    start = at - known.left(at, at + period)
    some = end - start >= np.maximum(min_words, exponent * period)
    start, end, period = start[some], end[some], period[some]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def collapse(docs: DataFrame, *keep: Column, min_words: int = MIN_WORDS, exponent: int = MIN_EXPONENT) -> DataFrame:
    """The columns ``keep`` (c0, c1, ...) of every row with n_words, runs and collapsed.

    ``runs`` is an array of (start, length, period) by start and period; ``collapsed`` has the words that are not in any run
    after its first period, joined by one blank.
    """
    names = [f"c{i}" for i in range(len(keep))]
    sent = docs.select(F.col("text").alias("_text"), *[c.alias(x) for c, x in zip(keep, names)])
    kinds = [f"{x} {f.dataType.simpleString()}" for x, f in zip(names, sent.schema.fields[1:])]

    def run(batches):
        word_hash = WordHash(20260301, fold=False)
        for batch in batches:
            for part in row_slices(batch, "_text", SLICE):
                data, off = utf8(part.column("_text"))
                rows = part.num_rows
                starts, ends, row = word_spans(data, off)
                n = np.bincount(row, minlength=rows)
                values = mix64(word_hash(data, starts, ends) ^ mix64(row.astype(np.uint64) + np.uint64(1)))
                a, b, q = find_runs(values, n, min_words, exponent)
                turn = np.zeros(len(values) + 1, np.int64)
                np.add.at(turn, a + q, 1)
                np.add.at(turn, b, -1)
                kept = np.cumsum(turn[:-1]) == 0
                first = np.cumsum(n) - n
                of = row[a] if len(a) else np.zeros(0, np.int64)
                runs = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=rows))], pa.int32()),
                    pa.StructArray.from_arrays([pa.array(a - first[of]), pa.array(b - a), pa.array(q)],
                                               ["start", "length", "period"]))
                text = joined(data, starts[kept], ends[kept], row[kept], rows)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(x) for x in names], pa.array(n.astype(np.int64)), runs, text.cast(pa.string())],
                    [*names, "n_words", "runs", "collapsed"])

    return sent.mapInArrow(run, ", ".join(
        [*kinds, "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"]))
