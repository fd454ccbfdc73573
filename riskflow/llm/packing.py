"""Best-fit packing of token sequences, bulk-synchronously.

Documents are tokenised once into a narrow table of pieces. Pieces and gaps are integers up to the capacity, so both
are range-sorted by length with equal lengths as one run: a run of pieces is (length, count), a run of gaps is
(gap, first sequence, count). A round sweeps all runs of pieces against the sorted gaps, each run asking for its
successor, the smallest gap that holds it; where several runs ask for one gap, the longer pieces rank first and the
rest asks again in the next round; matched gaps shrink. If no run fits a gap, new sequences are opened for the longest
unplaced run. The rounds see at most ``capacity`` runs whatever the input's size, so only this histogram reaches the
driver; the pieces stay in Spark: their ranks inside a run come from a distributed prefix count over hash ranges (a run
may hold any share of all pieces), and a join of (length, rank) with the matches places them.

Defined results: a null text counts as empty (just the end id); a null id stays null; repeated rows are packed each
on its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import stage

CAPACITY = 1024
VOCABULARY = "byte_bpe_50k"
ROWS_PER_RANGE = 50_000


def encoder(vocabulary: str = VOCABULARY):
    """text -> ids as a list, as the vocabulary's ``tokenizers`` file gives them without added tokens.

    The ids of ordinary text come from the same vocabulary's rank file, whose encoder is several times faster; a text
    that contains a special token's string goes through the ``tokenizers`` file itself.
    """
    import base64
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    path = public_tokenizers.path(f"{vocabulary}.json")
    with open(path, encoding="utf-8") as f:
        special = [t["content"] for t in json.load(f)["added_tokens"]]
    slow = []  # made for the first text that needs it

    def ids(text: str) -> list[int]:
        if any(s in text for s in special):
            if not slow:
                slow.append(Tokenizer.from_file(path))
            return slow[0].encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return ids


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones of ``capacity``, before them a shorter first one if any."""
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, (first if s == 0 and first else capacity)) for s in starts]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 2, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        ids_of = encoder(vocabulary)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at, cols = [], [[], [], [], []]
            for r in range(batch.num_rows):
                text = texts[r].as_py() or ""
                own = np.array([*ids_of(text), end_id], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(own), capacity)):
                    at.append(r)
                    for c, v in zip(cols, (k, start, length, zlib.crc32(own[start:start + length].tobytes()))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int64())), pa.array(cols[0], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in cols[1:]]], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def sweep(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Matches (length, first rank, count, first sequence, offset) for pieces given as {length: count}.

    The ranks [first, first + count) of a length go to consecutive sequences, one piece each, at that offset.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    ranked = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of (first sequence, count)
    matches, opened = [], 0

    def place(length: int, gap: int, first: int, count: int) -> None:
        matches.append((length, ranked[length], count, first, capacity - gap))
        ranked[length] += count
        left[length] -= count
        if not left[length]:
            del left[length]
        if gap > length:
            gaps.setdefault(gap - length, []).append((first, count))

    while left:
        sizes = np.array(sorted(gaps), dtype=np.int64)
        asked: dict[int, list[int]] = {}
        for length in sorted(left, reverse=True):
            at = int(np.searchsorted(sizes, length))
            if at < len(sizes):
                asked.setdefault(int(sizes[at]), []).append(length)
        if not asked:
            # no run fits any gap: open sequences for the longest, as many as its pieces need when stacked
            longest = max(left)
            n = math.ceil(left[longest] / (capacity // longest))
            place(longest, capacity, opened, n)
            opened += n
            continue
        for gap, lengths in asked.items():
            length = lengths[0]  # the longest asker ranks first; the others ask again
            runs = gaps.pop(gap)
            while runs and length in left:
                first, supply = runs.pop()
                n = min(supply, left[length])
                place(length, gap, first, n)
                if n < supply:
                    runs.append((first + n, supply - n))
            if runs:
                gaps.setdefault(gap, []).extend(runs)
    return matches


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 2, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``: gapless from 0 within each sequence of at most ``capacity``."""
    spark = docs.sparkSession
    p = stage(pieces(docs, capacity, end_id, vocabulary), "pieces")
    histogram = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    matches = spark.createDataFrame(sweep(histogram, capacity) or [(0, 0, 0, 0, 0)],
                                    "length long, first long, n long, seq long, at long")
    ranges = max(1, math.ceil(max(histogram.values(), default=0) / ROWS_PER_RANGE))
    h = F.xxhash64("doc_id", "piece", "ids_crc32")
    p = p.withColumn("h", h).withColumn("rng", F.pmod("h", F.lit(ranges)).cast("int"))
    totals = p.groupBy("length", "rng").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("length", "rng", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "rng").orderBy("h", F.col("doc_id").asc_nulls_last(), "piece", "ids_crc32")
    p = p.withColumn("own", F.row_number().over(inside)).join(starts, ["length", "rng"])
    p = p.withColumn("rank", F.col("base") + F.col("own") - 1)
    m = F.broadcast(matches.withColumnRenamed("length", "len"))  # bounded by the capacity, not by the input
    out = p.join(m, (p["length"] == m["len"]) & (p["rank"] >= m["first"]) & (p["rank"] < m["first"] + m["n"]))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("seq") + F.col("rank") - F.col("first")).alias("sequence_id"),
                      F.col("at").alias("offset"))
