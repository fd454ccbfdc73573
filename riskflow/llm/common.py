"""Helpers shared by the corpus operators: table reads, stage tables, word spans and hashes on Arrow text, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.session import cut_lineage, ship_package

#: Java form of the word pattern: maximal runs without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: str = "2m", default: str = "67108864b") -> None:
    """Batches of about ``size`` bytes between Spark and its Python workers, unless the session has a size of its own: a batch is held
    several times on its way, in both processes and once for each running task."""
    if spark.conf.get(_BATCH) == default:
        spark.conf.set(_BATCH, size)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared checkpoint folder and read back, so that later steps survive a lost executor."""
    return cut_lineage(df, f"llm-{name}")


def small(staged: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """A stored table of narrow rows, with a broadcast hint if a count shows that it is small; else joins shuffle it."""
    return F.broadcast(staged) if staged.count() <= max_rows else staged


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(doc_id: str, mod: int) -> Column:
    """crc32 of the id's decimal text modulo ``mod`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod


# ---- text in Arrow batches ------------------------------------------------------------------------------------------

def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the row offsets of a string column; null counts as the empty text."""
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    if not len(off):
        off = np.zeros(1, np.int64)
    return data[off[0]: off[-1]], off - off[0]


def row_slices(batch: pa.RecordBatch, text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``max_bytes`` of text (one row at least), so that work arrays stay small."""
    if not batch.num_rows:
        return
    _, off = utf8(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, off: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of all rows, and the row of each; words never cross rows.

    ``breaks`` marks the bytes that are in no word."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~breaks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = ink.copy()
    first[1:] &= ~ink[:-1] | edge[1:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur's); uint64 in and out."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHash:
    """64-bit hashes of byte spans, A-Z folded to a-z unless ``fold`` is off, from one running sum over the bytes.

    A span's hash is sum(T[byte] * p^(i - start)) mod 2^64, with random T, then mixed with its length.
    """

    def __init__(self, seed: int = 20240607, fold: bool = True):
        t = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if fold:
            t[65:91] = t[97:123]
        self.table, self.p = t, 0x9E3779B97F4A7C15
        self.inv, self.size = pow(self.p, -1, 2**64), 0

    def _grow(self, n: int) -> None:
        if n > self.size:
            n = max(n, 1 << 16)
            powers = np.full(n, self.p, np.uint64)
            inverse = np.full(n, self.inv, np.uint64)
            powers[0] = inverse[0] = 1
            self.powers, self.inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
            self.size = n

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        self._grow(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[: len(data)], out=total[1:])
        h = (total[ends] - total[starts]) * self.inverse[starts]
        return mix64(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


class WindowHash:
    """64-bit hashes of windows of consecutive values, from one running sum; ``values`` are 64-bit hashes already."""

    def __init__(self, values: np.ndarray, factor: int = 0xD1342543DE82EF95):
        n = len(values) + 1
        powers, self.inverse = np.full(n, factor, np.uint64), np.full(n, pow(factor, -1, 2**64), np.uint64)
        powers[0] = self.inverse[0] = 1
        powers = np.multiply.accumulate(powers)
        self.inverse = np.multiply.accumulate(self.inverse)
        self.total = np.zeros(n, np.uint64)
        np.cumsum(values * powers[:-1], out=self.total[1:])

    def __call__(self, at: np.ndarray, size: int) -> np.ndarray:
        return mix64((self.total[at + size] - self.total[at]) * self.inverse[at])


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """The words of each of ``n`` rows joined by one blank, as strings; ``rows`` ascends, a row without words is empty."""
    size = ends - starts
    to = np.cumsum(size + 1) - size - 1  # where a word begins in the output
    out = np.full(int(size.sum() + len(size)), 0x20, np.uint8)
    word = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(word)) - (to - np.arange(len(size)))[word]
    out[to[word] + step] = data[starts[word] + step]
    count = np.bincount(rows, minlength=n)
    off = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(rows, weights=size + 1, minlength=n).astype(np.int64) - (count > 0), out=off[1:])
    keep = np.ones(len(out), bool)
    keep[(to + size)[np.cumsum(count)[count > 0] - 1]] = False  # no blank after a row's last word
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(out[keep])))


def sorted_counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order and their counts."""
    if not len(x):
        return x, np.zeros(0, np.int64)
    x = np.sort(x)
    at = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    return x[at], np.diff(np.r_[at, len(x)])


def with_node(classes: DataFrame, *key: str) -> DataFrame:
    """The columns of ``classes`` with rep, a number of its own: the smallest id ``low`` or, where several classes have the
    same one, a hash of ``key``."""
    shared = classes.groupBy("low").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("low", F.lit(True).alias("_s"))
    d = classes.join(small(stage(shared, "shared-ids")), "low", "left")
    return d.withColumn("rep", F.when(F.col("_s"), F.xxhash64(*key)).otherwise(F.col("low"))).drop("_s")


# ---- connected components -------------------------------------------------------------------------------------------

def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component_id) for every node of ``edges`` (a, b), by alternating large-star and small-star rounds.

    component_id is the smallest id reachable. The large star is an aggregate (minimum neighbour, combined before the
    shuffle) and a join that adaptive execution can split, so a node with a third of all edges is no bottleneck. Rounds are stored in the shared folder; empty edges give an empty result.
    """
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(),
              "edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # a node's smaller neighbours are few after the large star, so a window may hold them
        m = F.min("v").over(Window.partitionBy("u"))
        ends = F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))
        small_ = large.withColumn("m", m).select(F.explode(ends).alias("x")).select(
            F.col("x.v").alias("u"), F.col("x.m").alias("v")).filter("u != v").distinct()
        e = stage(small_, "small")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if before == (now["n"], now["h"]):
            return (e.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
                    .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component_id"))).distinct())
        before = (now["n"], now["h"])
    raise RuntimeError(f"components have not settled in {max_rounds} rounds")
