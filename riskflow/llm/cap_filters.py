"""Near-duplicate embeddings by spherical-cap filters from a random product code.

The space is cut into two blocks of dimensions with a code of B random unit vectors each; the B * B pairs are the filter
directions. Every vector is owned by its best direction, at inner product a. A vector v that is within the angle t of
an owned vector u lies within arccos(a(u)) + t of u's direction, so list-decoding v to all directions that exceed
cos(arccos(lowest a of that direction's owners) + t) meets every near vector: unlike symmetric random filters this
loses no pair, and each ordered pair meets in exactly one direction, u's. A direction is also passed over where u would
have to be further away for it to be best in both blocks: if c is v's best word of a block and u's is c', then u and v differ
there by at least g = (v.c - v.c') / |c - c'|, so that g1^2 + g2^2 may not exceed |u - v|^2 <= 2 - 2 cos t. Vectors and owners are joined on (label,
direction) and verified in double precision in blocks. B grows with the square root of the largest label's rows, so a
direction's list stays about as long at every size; long lists (common vectors) are cut into blocks of bounded size for
both sides, and pairs are never emitted: a block gives link counts and a spanning forest of its links.

Defined results: vectors that are null, zero or hold null or non-finite components, vectors with a null label and rows
with a null id link with nothing and are their own component; vectors of different length are not compared; equal
vectors of a label are one node with a count; a repeated id with different vectors is judged by the least of them; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import components, small, stage, with_node

COSINE = 0.98
LIST = 256       # owners per direction to aim at
OWNERS, PROBES = 1024, 4096  # most rows of a block
SLACK = 1e-9     # added to every angle bound, far above rounding


@lru_cache(maxsize=64)
def code(dim: int, words: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Two blocks of random directions, scaled so that a pair's concatenation is a unit vector."""
    rng = np.random.default_rng([seed, dim, words])
    out = []
    for n in (dim - dim // 2, dim // 2):
        c = rng.standard_normal((words, n))
        out.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300) / math.sqrt(2 if dim > 1 else 1))
    return out[0], out[1]


def _matrix(col) -> np.ndarray:
    """An Arrow list column of equal-length vectors as rows of doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten(), dtype=np.float64).reshape(len(col), -1)


def products(x: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of the normalised rows with the directions of both blocks."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = code(x.shape[1], words)
    return x[:, : a.shape[1]] @ a.T, x[:, a.shape[1]:] @ b.T


@lru_cache(maxsize=64)
def apart(dim: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances between the words of either block."""
    out = []
    for c in code(dim, words):
        n = (c * c).sum(axis=1)
        out.append(np.sqrt(np.maximum(n[:, None] + n[None, :] - 2 * c @ c.T, 0)))
    return out[0], out[1]


def gaps(p: np.ndarray, distances: np.ndarray) -> np.ndarray:
    """Per row and word, the square of the least distance to a vector for which that word is the block's best."""
    best = p.argmax(axis=1)
    d = distances[best]
    return np.divide(p[np.arange(len(p)), best][:, None] - p, d, out=np.zeros_like(p), where=d > 1e-6) ** 2


def decode(p: np.ndarray, q: np.ndarray, least: float, gp: np.ndarray, gq: np.ndarray, far: float
           ) -> tuple[np.ndarray, np.ndarray]:
    """All directions (i * B + j) with p[i] + q[j] >= least and gp[i] + gq[j] <= far, and the sums of p and q; only block
    words that can reach both are paired."""
    i, j = np.flatnonzero((p >= least - q.max()) & (gp <= far)), np.flatnonzero((q >= least - p.max()) & (gq <= far))
    s = p[i][:, None] + q[j][None, :]
    r, c = np.nonzero((s >= least) & (gp[i][:, None] + gq[j][None, :] <= far))
    return (i[r] * len(q) + j[c]).astype(np.int64), s[r, c]


def _by_dim(batch: pa.RecordBatch):
    dims = np.asarray(batch.column("dim"))
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield at, _matrix(batch.column("vec").take(pa.array(at)))


def _linked(x: pa.Table, cosine: float) -> pa.Table:
    """A block's link counts per probing vector, and its nodes with the least node they reach inside the block."""
    x = x.combine_chunks()
    owner = np.asarray(x.column("owner").combine_chunks().cast(pa.int8())) == 1
    rep, n = np.asarray(x.column("rep").combine_chunks()), np.asarray(x.column("n").combine_chunks())
    v = _matrix(x.column("vec"))
    norm = np.sqrt((v * v).sum(axis=1))
    o, p = np.flatnonzero(owner), np.flatnonzero(~owner)
    none = pa.table({"rep": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
    if not len(o) or not len(p):
        return none
    hit = (v[p] @ v[o].T) / (norm[p][:, None] * norm[o][None, :]) >= cosine
    hit &= rep[p][:, None] != rep[o][None, :]
    links = hit @ n[o]
    rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    if not len(rows):
        return none
    hit = hit[np.ix_(rows, cols)]
    big = np.iinfo(np.int64).max
    low_p, low_o = rep[p[rows]].copy(), rep[o[cols]].copy()
    while True:
        new_o = np.minimum(low_o, np.where(hit, low_p[:, None], big).min(axis=0))
        new_p = np.minimum(low_p, np.where(hit, new_o[None, :], big).min(axis=1))
        if (new_o == low_o).all() and (new_p == low_p).all():
            break
        low_o, low_p = new_o, new_p
    return pa.table({"rep": np.r_[rep[p[rows]], rep[o[cols]]],
                     "links": np.r_[links[rows], np.zeros(len(cols), np.int64)], "root": np.r_[low_p, low_o]})


def near_vectors(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept (vec_id = component_id) of every row (vec_id, embedding, label)."""
    angle, far = math.acos(cosine) + SLACK, 2 - 2 * cosine + 1e-6  # as above; a gap's rounding is below 1e-9
    ok = F.expr("vec_id is not null and label is not null and size(embedding) > 0 and "
                "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and "
                "exists(embedding, x -> x != 0)")
    d = rows.select("vec_id", "label", F.when(ok, F.col("embedding")).alias("vec"))
    nodes = d.filter("vec is not null").groupBy("label", "vec").agg(F.min("vec_id").alias("low"),
                                                                     F.count(F.lit(1)).alias("n"))
    named = stage(with_node(stage(nodes, "classes"), "label", "vec").select(
        "rep", "low", "label", F.size("vec").alias("dim"), "vec", "n"), "vectors")
    nodes = named.drop("low")
    most = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0
    words = max(2, math.ceil(math.sqrt(most / LIST)))

    def owned(batches):
        for b in batches:
            cell, a = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for at, x in _by_dim(b):
                p, q = products(x, words)
                cell[at], a[at] = p.argmax(axis=1) * words + q.argmax(axis=1), p.max(axis=1) + q.max(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(a)], [*b.schema.names, "cell", "a"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    owners = stage(nodes.mapInArrow(owned, f"{kinds}, cell long, a double"), "owners")
    floor = owners.agg(F.min("a")).first()[0]
    floor = 0.0 if floor is None else floor
    reach = math.cos(min(math.pi, math.acos(max(-1.0, min(1.0, floor))) + angle))

    def probing(batches):
        for b in batches:
            found: list = [None] * b.num_rows
            for at, x in _by_dim(b):
                p, q = products(x, words)
                gp, gq = (gaps(y, d) for y, d in zip((p, q), apart(x.shape[1], words)))
                for k, r in enumerate(at):
                    found[r] = decode(p[k], q[k], reach, gp[k], gq[k], far)
            off = np.cumsum([0, *[len(f[0]) for f in found]]).astype(np.int32)
            cells = pa.array(np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64))
            ips = pa.array(np.concatenate([f[1] for f in found]) if found else np.zeros(0))
            hits = pa.StructArray.from_arrays([cells, ips], ["cell", "ip"])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(off), hits)],
                                             [*b.schema.names, "hits"])

    cells = stage(owners.groupBy("label", "dim", "cell").agg(F.count(F.lit(1)).alias("k"), F.min("a").alias("low"))
                  .withColumn("least", F.cos(F.least(F.lit(math.pi), F.acos(F.greatest(F.lit(-1.0), F.least(
                      F.lit(1.0), "low"))) + angle))), "cells")
    key = ["label", "dim", "cell"]
    probes = (nodes.mapInArrow(probing, f"{kinds}, hits array<struct<cell: long, ip: double>>")
              .select("rep", "label", "dim", "vec", "n", F.explode("hits").alias("h"))
              .select("rep", "label", "dim", "vec", "n", "h.cell", "h.ip"))
    probes = probes.join(small(cells), key).filter("ip >= least").drop("ip", "low", "least")
    asked = stage(probes.groupBy(*key).agg(F.count(F.lit(1)).alias("m")), "asked")
    blocks = stage(cells.join(asked, key).select(
        *key, F.ceil(F.col("k") / OWNERS).cast("int").alias("ko"), F.ceil(F.col("m") / PROBES).cast("int").alias("kp")),
        "blocks")
    h = F.xxhash64("rep")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (owners.join(small(blocks), key).withColumn("i", F.pmod(h, F.col("ko")).cast("int"))
            .withColumn("j", every("kp")).withColumn("owner", F.lit(True)))
    right = (probes.join(small(blocks), key).withColumn("j", F.pmod(h, F.col("kp")).cast("int"))
             .withColumn("i", every("ko")).withColumn("owner", F.lit(False)))
    cols = [*key, "i", "j", "owner", "rep", "n", "vec"]
    found = (left.select(*cols).unionByName(right.select(*cols)).groupBy(*key, "i", "j")
             .applyInArrow(lambda x: _linked(x, cosine), "rep long, links long, root long"))
    found = stage(found, "links")
    low = named.select("rep", "low")
    ends = found.filter("rep != root").select("rep", "root").join(low, "rep").join(
        low.select(F.col("rep").alias("root"), F.col("low").alias("low_root")), "root")
    comp = components(ends.select(F.col("low").alias("a"), F.col("low_root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per_node = stage(named.select("rep", "low", "label", "vec", "n").join(links, "rep", "left").join(
        comp.select(F.col("id").alias("low"), "component_id"), "low", "left").select(
        "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component_id", "low").alias("component_id")), "nodes")
    out = d.join(per_node, ["label", "vec"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.expr("vec_id <=> coalesce(component_id, vec_id)").alias("kept"))
