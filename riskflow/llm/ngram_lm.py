"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, stored as sorted arrays, memory-mapped by workers.

``order`` is 3 (or 2). Training is passes of tasks that send each other sorted, compressed count arrays instead of a row
per n-gram:

1. vocabulary: every task sums its word hashes and sends each hash range's part on; a range's task merges the parts
   into sorted arrays (hash, count). A word's number is its place in them. One end token closes every text.
2. bigrams: every task maps the vocabulary, sums its pairs (context number, word number) and sends each pair to the part
   of its context. Contexts with more than a quarter of a part's tokens (at most four per part) are dealt by the word
   instead, so that no context, however common, makes a part large. A part's task merges the pairs into sorted arrays.
3. trigrams: every task maps the pairs and sends (place of the first two words' pair, word) to that pair's part, whose task
   merges them into sorted arrays and sums, per pair, how many trigrams follow once, twice and more often. A pair of
   very common words brings at most its distinct followers there.
4. continuations: per pair the number of different words before it, and per word the number of different contexts, summed
   in the part of the pair or word; per context how many followers have one, two and more.

The parts are files in a folder that all executors share (the checkpoint folder, or ``folder``); workers map them and
look up sorted queries, so memory holds only touched pages. The driver sees counts of counts, part totals and the common
contexts, all bounded by the number of parts. Files are written under a temporary name and renamed, so a task may be
repeated on another executor at any time.

p(w | uv) = (c(uvw) - D(c)) / c(uv) + g(uv) p(w | v);  p(w | v) = (k(vw) - D(k)) / K(v) + g(v) p(w);
p(w) = (k(w) - D(k)) / K + g / (V + 1), with k the number of different words before (the count itself after a text's
start, and at order 2) and K its sums. A text's first word has the start as its only context. Unknown words share one
place in V + 1; an unknown context leaves the lower order's probability.

Defined results: a null text is empty, its only token is the end; a null id counts as the empty text in the hold-out rule;
repeated rows are counted and scored each on their own; without training rows V and N are 0 and every token has
probability 1; an empty table gives an empty result; other columns are ignored; an order that is not 2 or 3 is refused.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.common import WordHash, row_slices, shuffle_tasks, stage, utf8, word_spans
from riskflow.session import scratch_dir

_HASH = WordHash(9)
END = np.uint64(0xE4D0E4D0E4D0E4D0)
START_ID = (1 << 32) - 1     # the context of a text's first word
UNKNOWN_ID = (1 << 32) - 2   # a word or context that training has not seen
FLUSH = 4_000_000            # tokens that a task sums before it sends them on
LOW = np.uint64(0xFFFFFFFF)


# ---- sorted arrays as bytes -------------------------------------------------------------------------------------------

def squeeze(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys and their counts, as differences in byte planes, compressed."""
    d = np.diff(keys.astype(np.uint64), prepend=np.uint64(0)).astype("<u8")
    planes = [d.view(np.uint8).reshape(-1, 8).T.tobytes(), counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()]
    return len(keys).to_bytes(8, "little") + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unsqueeze(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(raw[:8], "little")
    flat = np.frombuffer(pa.decompress(raw[8:], decompressed_size=12 * n, codec="zstd", asbytes=True), np.uint8)
    d = np.ascontiguousarray(flat[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    c = np.ascontiguousarray(flat[8 * n:].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(d.astype(np.uint64)), c.astype(np.int64)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Key arrays and counts merged to distinct ascending keys with summed counts."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(x, return_counts=True)


class Sums:
    """Counts of uint64 keys, merged now and then so that memory follows the distinct keys."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray) -> bool:
        self.parts.append(_counted(keys))
        self.held += len(keys)
        return self.held > FLUSH

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = summed(self.parts)
        self.__init__()
        return out


# ---- the model's folder -----------------------------------------------------------------------------------------------

def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """A new folder below the checkpoint folder (or ``folder``), as a path that every worker can map.

    Memory-mapping needs a mounted folder: a checkpoint folder in an object store is refused; name a mounted one.
    """
    url = urlparse(folder or scratch_dir(spark))
    if url.scheme not in ("", "file"):
        raise ValueError(f"{url.scheme}: cannot be memory-mapped; pass a mounted folder")
    path = os.path.join(unquote(url.path), f"llm-model-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


def _save(path: str, x: np.ndarray) -> None:
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(tmp, "wb") as f:
        np.save(f, x)
    os.replace(tmp, path)


def _least(x: np.ndarray) -> np.ndarray:
    """Counts in the smallest unsigned type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _map(path: str) -> np.ndarray:
    return np.load(path, mmap_mode="r") if os.path.exists(path) else np.zeros(0, np.uint64)


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    """The hash range of each hash: ``parts`` equal ranges, ascending with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


class Vocabulary:
    """Word hashes to numbers, from the mapped parts."""

    def __init__(self, folder: str, starts: list[int]):
        self.starts, self.parts = starts, len(starts) - 1
        self.hash = [_map(f"{folder}/hash-{p}.npy") for p in range(self.parts)]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        order = np.argsort(h)
        asked, out = h[order], np.full(len(h), UNKNOWN_ID, np.uint64)
        cut = np.searchsorted(_part(asked, self.parts), np.arange(self.parts + 1))
        for p in range(self.parts):
            have, q = self.hash[p], asked[cut[p]: cut[p + 1]]
            if len(q) and len(have):
                at = np.minimum(np.searchsorted(have, q), len(have) - 1)
                hit = np.asarray(have[at]) == q
                out[order[cut[p]: cut[p + 1]][hit]] = at[hit] + self.starts[p]
        return out


class Pairs:
    """Places of bigrams (context number << 32 | word number) in the mapped parts."""

    def __init__(self, folder: str, starts: list[int], hot: np.ndarray):
        self.starts, self.parts, self.hot = np.array(starts, np.int64), len(starts) - 1, hot
        self.key = [_map(f"{folder}/pair-{p}.npy") for p in range(2 * self.parts)]

    def part(self, keys: np.ndarray) -> np.ndarray:
        """The part of each pair: its context's, or for common contexts the word's in a second row of parts."""
        v, w = keys >> np.uint64(32), keys & LOW
        is_hot = np.isin(v, self.hot)
        return np.searchsorted(self.starts, np.where(is_hot, w, v), side="right") - 1 + self.parts * is_hot

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts and places of ascending distinct pairs; place -1 for those that training has not seen."""
        known = (keys & LOW < UNKNOWN_ID) & (keys >> np.uint64(32) != UNKNOWN_ID)
        part = np.where(known, self.part(keys), -1)
        out = np.full(len(keys), -1, np.int64)
        for p, ix in _by_part(part):
            have = self.key[p]
            if len(have):
                at = np.minimum(np.searchsorted(have, keys[ix]), len(have) - 1)
                out[ix] = np.where(np.asarray(have[at]) == keys[ix], at, -1)
        return part, out


def _by_part(part: np.ndarray):
    """(part, its rows in their order) for every part from 0 on."""
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1], True]) if len(part) else [0]
    for a, b in zip(cut[:-1], cut[1:]):
        if part[order[a]] >= 0:
            yield int(part[order[a]]), order[a:b]


def _at(arrays: list, part: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Values of mapped arrays, one a part, at places; 0 at place -1."""
    out = np.zeros(len(place), np.int64)
    for p, ix in _by_part(np.where(place >= 0, part, -1)):
        out[ix] = arrays[p][place[ix]]
    return out


def _first_at_least(have: np.ndarray, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Per k, the first place of have[lo[k]: hi[k]], which ascends, with a value of x[k] or more; hi[k] without one."""
    lo, hi = lo.copy(), hi.copy()
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        mid = (lo[open_] + hi[open_]) // 2
        less = have[mid] < x[open_]
        lo[open_[less]], hi[open_[~less]] = mid[less] + 1, mid[~less]
        open_ = open_[lo[open_] < hi[open_]]
    return lo


def tokens(batch: pa.RecordBatch, text: str):
    """Per slice of rows: word hashes with END after each row's words, and the offsets of the rows."""
    for part in row_slices(batch, text):
        data, off = utf8(part.column(text))
        starts, ends, row = word_spans(data, off)
        h = _HASH(data, starts, ends)
        n = np.bincount(row, minlength=part.num_rows)
        at = np.r_[0, np.cumsum(n + 1)]
        all_ = np.full(at[-1], END, np.uint64)
        all_[np.arange(len(h)) + row] = h
        yield part, all_, at


def _contexts(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    v = np.empty_like(ids)
    v[1:] = ids[:-1]
    v[at[:-1]] = START_ID
    return v


def _deal(keys, counts, part: np.ndarray, names=("p", "raw")):
    """A row (part, squeezed keys and counts) for each part."""
    ps, raws = [], []
    for p, ix in _by_part(part):
        ps.append(p)
        raws.append(squeeze(keys[ix], counts[ix]))
    return pa.RecordBatch.from_arrays([pa.array(ps, pa.int32()), pa.array(raws, pa.binary())], list(names))


def _merged(x: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return summed([unsqueeze(r.as_py()) for r in x.column("raw")])


# ---- training ---------------------------------------------------------------------------------------------------------

def discounts(t: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more from the counts of counts 1 to 4.

    Where a count of counts is missing, as in tiny corpora, or a discount leaves (0, count), half of one is taken off.
    """
    d = np.array([0.0, 0.5, 0.5, 0.5])
    if t[0] > 0 and t[1] > 0:
        y = t[0] / (t[0] + 2 * t[1])
        for k in (1, 2, 3):
            x = k - (k + 1) * y * t[k] / t[k - 1] if t[k - 1] else 0.0
            d[k] = x if 0 < x < k else 0.5
    return d


def _few(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def _tails(counts: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Per owner, how many of its counts are 1, 2, and 3 or more."""
    return np.stack([np.bincount(owner[np.minimum(counts, 3) == i], minlength=owners) for i in (1, 2, 3)])


def train(docs: DataFrame, chosen: Column, folder: str | None = None, order: int = 3) -> dict:
    """The model of the chosen documents: a small description with the folder of its arrays."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: 2 or 3")
    spark = docs.sparkSession
    parts, path = shuffle_tasks(spark), shared_folder(spark, folder)
    text = docs.filter(chosen).select("text")

    def words(batches):
        sums = Sums()
        for b in batches:
            for _, h, _ in tokens(b, "text"):
                if sums.add(h):
                    k, c = sums.take()
                    yield _deal(k, c, _part(k, parts).astype(np.int64))
        k, c = sums.take()
        yield _deal(k, c, _part(k, parts).astype(np.int64))

    def vocabulary(x: pa.Table) -> pa.Table:
        p = x.column("p")[0].as_py()
        k, c = _merged(x)
        _save(f"{path}/hash-{p}.npy", k)
        _save(f"{path}/count-{p}.npy", c)
        return pa.table({"p": pa.array([p], pa.int32()), "n": pa.array([len(k)], pa.int64()),
                         "tokens": pa.array([int(c.sum())], pa.int64())})

    got = stage(text.mapInArrow(words, "p int, raw binary").groupBy("p").applyInArrow(
        vocabulary, "p int, n long, tokens long"), "lm-vocabulary").collect()
    n = {r["p"]: r["n"] for r in got}
    starts = np.cumsum([0, *[n.get(p, 0) for p in range(parts)]]).tolist()
    total = sum(r["tokens"] for r in got)
    model = {"folder": path, "parts": parts, "starts": starts, "words": starts[-1], "tokens": total, "order": order}
    if starts[-1] >= UNKNOWN_ID:
        raise ValueError("more distinct words than 32-bit numbers")

    def common(batches):  # contexts with more than a quarter of a part's tokens
        for b in batches:
            for p in b.column(0).to_pylist():
                c = _map(f"{path}/count-{p}.npy")
                at = np.flatnonzero(np.asarray(c) > total / (4 * parts))
                yield pa.RecordBatch.from_arrays([pa.array(at + starts[p], pa.int64())], ["v"])

    hot = [r["v"] for r in spark.createDataFrame([(p,) for p in range(parts)], "p int").repartition(
        min(parts, 64)).mapInArrow(common, "v long").collect()]
    hot = np.array(sorted([*hot, START_ID]), np.uint64)
    model["hot"] = hot

    def pairs(batches):
        have, at_, sums = Vocabulary(path, starts), Pairs(path, starts, hot), Sums()

        def flush():
            k, c = sums.take()
            return _deal(k, c, at_.part(k))

        for b in batches:
            for _, h, at in tokens(b, "text"):
                ids = have.numbers(h)
                if sums.add(_contexts(ids, at) << np.uint64(32) | ids):
                    yield flush()
        yield flush()

    def contexts(p: int, k: np.ndarray, c: np.ndarray) -> list[list[int]]:
        """Saves, for the contexts of a part's pairs k, the tails and the sum of c; those of common contexts are returned."""
        v = k >> np.uint64(32)
        if p < parts:  # all pairs of these contexts are here
            own, n = (v - np.uint64(starts[p])).astype(np.int64), starts[p + 1] - starts[p]
            _save(f"{path}/tails-{p}.npy", _least(_tails(c, own, n)))
            _save(f"{path}/total-{p}.npy", _least(np.bincount(own, c, n).astype(np.uint64)))
            return []
        own = np.searchsorted(hot, v)
        found = np.vstack([np.bincount(own, c, len(hot)).astype(np.int64), _tails(c, own, len(hot))]).T
        return [[int(a), *x] for a, x in zip(hot, found.tolist()) if x[0]]

    def merge(x: pa.Table) -> pa.Table:
        p = x.column("p")[0].as_py()
        k, c = _merged(x)
        _save(f"{path}/pair-{p}.npy", k)
        _save(f"{path}/pairs-{p}.npy", _least(c))
        u, m = _counted(k & LOW)
        return _sent(_deal(u, m, np.searchsorted(starts, u, side="right") - 1), c, contexts(p, k, c) if order == 2 else [])

    def _sent(dealt: pa.RecordBatch, c: np.ndarray, tails: list) -> pa.Table:
        """The dealt arrays, with the counts of counts of c and the common contexts' tails in the first row."""
        rows = dealt.num_rows
        return pa.table({"p": dealt.column("p"), "raw": dealt.column("raw"),
                         "few": pa.array([_few(c) if r == 0 else None for r in range(rows)], pa.list_(pa.int64())),
                         "tails": pa.array([tails if r == 0 else None for r in range(rows)], pa.list_(pa.list_(pa.int64())))})

    def triples(batches):
        have, known, held = Vocabulary(path, starts), Pairs(path, starts, hot), []

        def flush():
            part, key = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
            held.clear()
            by = np.lexsort((key, part))
            part, key = part[by], key[by]
            new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])]) if len(key) else np.zeros(0, np.int64)
            return _deal(key[new], np.diff(np.r_[new, len(key)]), part[new])

        for b in batches:
            for _, h, at in tokens(b, "text"):
                ids = have.numbers(h)
                keys, where = np.unique(_contexts(ids, at) << np.uint64(32) | ids, return_inverse=True)
                part, place = known.places(keys)
                later = np.setdiff1d(np.arange(len(ids)), at[:-1], assume_unique=True)
                before = where[later - 1]
                held.append((part[before], place[before].astype(np.uint64) << np.uint64(32) | ids[later]))
                if sum(len(x[0]) for x in held) > FLUSH // 2:
                    yield flush()
        yield flush()

    def merge_triples(x: pa.Table) -> pa.Table:
        p = x.column("p")[0].as_py()
        k, c = _merged(x)
        first = _map(f"{path}/pair-{p}.npy")
        at = (k >> np.uint64(32)).astype(np.int64)
        _save(f"{path}/triple-{p}.npy", k.astype(np.uint32))  # the words; those after pair i are at from[i]:from[i + 1]
        _save(f"{path}/from-{p}.npy", _least(np.r_[0, np.cumsum(np.bincount(at, minlength=len(first)))]))
        _save(f"{path}/triples-{p}.npy", _least(c))
        for i, n in enumerate(_tails(c, at, len(first))[:2]):  # the rest of a pair's followers have 3 or more
            _save(f"{path}/follow{i + 1}-{p}.npy", _least(n))
        u, m = _counted((np.asarray(first)[at] & LOW) << np.uint64(32) | k & LOW)
        return _sent(_deal(u, m, Pairs(path, starts, hot).part(u)), c, [])

    def before_pairs(x: pa.Table) -> pa.Table:
        p = x.column("p")[0].as_py()
        k, c = _merged(x)
        have = np.asarray(_map(f"{path}/pair-{p}.npy"))
        kinds = np.zeros(len(have), np.int64)
        kinds[np.searchsorted(have, k)] = c
        first = have >> np.uint64(32) == START_ID
        kinds[first] = np.asarray(_map(f"{path}/pairs-{p}.npy"))[first]
        _save(f"{path}/kinds-{p}.npy", _least(kinds))
        above = [v.as_py() for v in x.column("few") if v.is_valid]
        return pa.table({"few": pa.array([_few(kinds)], pa.list_(pa.int64())),
                         "above": pa.array([np.sum([[0] * 4, *above], axis=0).tolist()], pa.list_(pa.int64())),
                         "tails": pa.array([contexts(p, have, kinds)], pa.list_(pa.list_(pa.int64())))})

    deal = "p int, raw binary, few array<long>, tails array<array<long>>"
    made = stage(text.mapInArrow(pairs, "p int, raw binary").groupBy("p").applyInArrow(merge, deal), "lm-pairs")
    context_rows = made
    if order == 3:
        # not written in between: only files are made on the way, and the same ones if a task is repeated
        followed = text.mapInArrow(triples, "p int, raw binary").groupBy("p").applyInArrow(merge_triples, deal)
        none = squeeze(np.zeros(0, np.uint64), np.zeros(0, np.int64))  # a part of first pairs alone gets no other row
        every = spark.range(2 * parts).select(F.col("id").cast("int").alias("p"), F.lit(none).alias("raw"),
                                              F.lit(None).cast("array<long>").alias("few"))
        context_rows = stage(followed.select("p", "raw", "few").unionByName(every).groupBy("p").applyInArrow(
            before_pairs, "few array<long>, above array<long>, tails array<array<long>>"), "lm-before")
        model["d3"] = discounts(np.sum([r["above"] for r in context_rows.select("above").collect()], axis=0).tolist())
    few, tails = np.zeros(4, np.int64), {}
    for r in context_rows.filter("few is not null").select("few", "tails").collect():
        few += np.array(r["few"])
        for v, *x in r["tails"]:
            tails[v] = tails.get(v, np.zeros(4, np.int64)) + np.array(x)
    found = np.array([tails.get(int(v), np.zeros(4, np.int64)) for v in hot], np.int64).reshape(-1, 4)
    model["hot_totals"], model["hot_tails"] = found[:, 0], found[:, 1:]

    def continuations(x: pa.Table) -> pa.Table:
        p = x.column("p")[0].as_py()
        k, c = _merged(x)
        own = np.zeros(starts[p + 1] - starts[p], np.uint32)
        own[(k - np.uint64(starts[p])).astype(np.int64)] = c
        _save(f"{path}/cont-{p}.npy", own)
        return pa.table({"kinds": pa.array([int(c.sum())], pa.int64()), "few": pa.array([_few(c)], pa.list_(pa.int64())),
                         "more": pa.array([int((c > 2).sum())], pa.int64())})

    kept = stage(made.select("p", "raw").groupBy("p").applyInArrow(
        continuations, "kinds long, few array<long>, more long"), "lm-continuations").collect()
    low = np.sum([r["few"] for r in kept], axis=0) if kept else np.zeros(4, np.int64)
    model["kinds"] = sum(r["kinds"] for r in kept)
    model["d2"], model["d1"] = discounts(few.tolist()), discounts(low.tolist())
    tail = np.array([low[0], low[1], sum(r["more"] for r in kept)], np.float64)
    model["g1"] = float(model["d1"][1:] @ tail / model["kinds"]) if model["kinds"] else 1.0
    return model


class Model:
    """Probabilities from the mapped arrays."""

    def __init__(self, model: dict):
        self.m, f, self.parts = model, model["folder"], model["parts"]
        self.starts = np.array(model["starts"], np.int64)
        self.vocabulary, self.pairs = Vocabulary(f, model["starts"]), Pairs(f, model["starts"], model["hot"])
        of = lambda x, n=1: [_map(f"{f}/{x}-{p}.npy") for p in range(n * self.parts)]
        self.count, self.cont, self.total, self.tails = of("count"), of("cont"), of("total"), of("tails")
        self.seen = of("pairs", 2)
        if model["order"] == 3:
            self.kinds, self.triple, self.triples = of("kinds", 2), of("triple", 2), of("triples", 2)
            self.start, self.once, self.twice = of("from", 2), of("follow1", 2), of("follow2", 2)

    def _of(self, arrays: list, ids: np.ndarray) -> np.ndarray:
        """Values at ascending word numbers; 0 for unknown ones."""
        out = np.zeros(len(ids), np.int64)
        cut = np.searchsorted(ids, self.starts)
        for p in range(self.parts):
            if cut[p + 1] > cut[p] and len(arrays[p]):
                out[cut[p]: cut[p + 1]] = arrays[p][(ids[cut[p]: cut[p + 1]] - np.uint64(self.starts[p])).astype(np.int64)]
        return out

    def words(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ascending distinct word numbers: their counts, and their probability without a context."""
        m = self.m
        c, k = self._of(self.count, ids), self._of(self.cont, ids)
        return c, m["g1"] / (m["words"] + 1) + np.maximum(k - m["d1"][np.minimum(k, 3)], 0) / max(m["kinds"], 1)

    def contexts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ascending distinct context numbers: the sums over their followers, and the weights of the order below."""
        total, tail = self._of(self.total, ids), np.zeros((len(ids), 3))
        cut = np.searchsorted(ids, self.starts)
        for q in range(self.parts):
            own = ids[cut[q]: cut[q + 1]]
            if len(own) and len(self.tails[q]):
                tail[cut[q]: cut[q + 1]] = self.tails[q][:, (own - np.uint64(self.starts[q])).astype(np.int64)].T
        hot = self.m["hot"]
        at = np.minimum(np.searchsorted(hot, ids), len(hot) - 1)
        is_hot = hot[at] == ids
        total[is_hot], tail[is_hot] = self.m["hot_totals"][at[is_hot]], self.m["hot_tails"][at[is_hot]]
        return total, tail @ self.m["d2"][1:] / np.maximum(total, 1)

    def after_pairs(self, part: np.ndarray, place: np.ndarray, words: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities of words after the pairs at places, from those one order below."""
        d, total = self.m["d3"], _at(self.seen, part, place)
        c, tail = np.zeros(len(words), np.int64), np.zeros((len(words), 3))
        for p, ix in _by_part(np.where(place >= 0, part, -1)):
            have, spot = self.triple[p], place[ix]
            if len(have):
                lo, end = (np.asarray(self.start[p][spot + k]).astype(np.int64) for k in (0, 1))
                at = _first_at_least(have, words[ix], lo, end)
                hit = np.flatnonzero(at < end)
                hit = hit[have[at[hit]] == words[ix[hit]]]
                c[ix[hit]] = self.triples[p][at[hit]]
                one, two = (np.asarray(x[p][spot]).astype(np.int64) for x in (self.once, self.twice))
                tail[ix] = np.stack([one, two, end - lo - one - two], axis=1)
        own = np.maximum(c - d[np.minimum(c, 3)], 0) / np.maximum(total, 1) + tail @ d[1:] / np.maximum(total, 1) * lower
        return np.where(total > 0, own, lower)

    def score(self, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: known tokens, base score and the model's log10 probability."""
        m = self.m
        ids = self.vocabulary.numbers(h)
        u, place = np.unique(ids, return_inverse=True)
        c, p = self.words(u)
        base = np.log10((c + 1) / (m["tokens"] + m["words"] + 1))[place]
        keys, where = np.unique(_contexts(ids, at) << np.uint64(32) | ids, return_inverse=True)
        part, spot = self.pairs.places(keys)
        k = _at(self.seen if m["order"] == 2 else self.kinds, part, spot)
        v, of = np.unique(keys >> np.uint64(32), return_inverse=True)
        total, weight = (x[of] for x in self.contexts(v))
        lower = p[np.searchsorted(u, keys & LOW)]
        own = np.where(total > 0, np.maximum(k - m["d2"][np.minimum(k, 3)], 0) / np.maximum(total, 1) + weight * lower, lower)
        own, first = own[where], at[:-1]
        if m["order"] == 3:  # the pair that ends before a word is its context
            later = np.setdiff1d(np.arange(len(ids)), first, assume_unique=True)
            before = where[later - 1]
            own[later] = self.after_pairs(part[before], spot[before], ids[later], own[later])
        return (np.add.reduceat((c > 0).astype(np.int64)[place], first), np.add.reduceat(base, first),
                np.add.reduceat(np.log10(own), first))


def score(docs: DataFrame, model: dict, *more: Column) -> DataFrame:
    """The columns ``more`` with n_tokens, n_known, base_score and score of every whole text."""
    names = [f"c{i}" for i in range(len(more))]
    sent = docs.select("text", *[c.alias(n) for c, n in zip(more, names)])
    kinds = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, sent.schema.fields[1:])]

    def run(batches):
        own = Model(model)
        for b in batches:
            for part, h, at in tokens(b, "text"):
                known, base, got = own.score(h, at)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(np.diff(at)), pa.array(known), pa.array(base), pa.array(got)],
                    [*names, "n_tokens", "n_known", "base_score", "score"])

    return sent.mapInArrow(run, ", ".join([*kinds, "n_tokens long, n_known long, base_score double, score double"]))


def fit_and_score(docs: DataFrame, held: Column, *more: Column, order: int = 3) -> DataFrame:
    """Scores of all documents under the model of those that are not held out; ``more`` columns come along."""
    model = train(docs, ~held, order=order)
    return score(docs, model, *more, held).withColumn("train_tokens", F.lit(model["tokens"]).cast("bigint"))
