"""The pipeline's stages against brute force, and their behaviour on odd tables."""

import re
import zlib
from collections import Counter

import corpus_pipeline
from conftest import SMALL

from test_llm_edges import frame, odd  # noqa: F401


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "secret_scan", "source_mix", "best_fit_packing"]


def test_odd_rows(spark, odd):  # noqa: F811
    d = odd
    for name, fn in corpus_pipeline.STAGES:
        for x in (d, d.limit(0)):
            out = fn(spark, x, SMALL)
            if name != "best_fit_packing":
                assert out.columns == odd.columns and out.dtypes == odd.dtypes
            n = out.count()
        assert n == 0
        d = fn(spark, d, SMALL)


def _shingles(text, n):
    w = text.encode().lower().split()
    n = min(n, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def test_run(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    left = {i for i, r in docs.items() if r.text and any(c.isalpha() for c in r.text)}
    sets = {i: _shingles(docs[i].text, 5) for i in left}
    comp = {i: i for i in left}
    links = [(a, b) for a in left for b in left if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in links:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    left = {i for i in left if comp[i] == i or not sets[i]}
    texts = {}
    for i in left:
        t = docs[i].text
        spans = [(m.start(), m.end()) for m in re.finditer(
            r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.ASCII) if len(m[2]) >= 12]
        spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}", t)]
        out, at = [], 0
        for s, e in sorted(spans):
            if s >= at:
                out += [t[at:s], "[SECRET]"]
            at = max(at, e)
        texts[i] = "".join([*out, t[at:]])
    # the mix by its definition, on what is left
    import hashlib

    size = {i: len(t.encode().split()) for i, t in texts.items()}
    sources = sorted({docs[i].source for i in left if docs[i].source is not None}) + [None] * any(docs[i].source is None for i in left)
    total = {s: sum(size[i] for i in left if docs[i].source == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, free, rest = {}, set(sources), 1.5 * sum(total.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= 2 * total[s]}
        if not full:
            break
        target |= {s: 2.0 * total[s] for s in full}
        rest, free = rest - sum(2 * total[s] for s in full), free - full
    target |= share
    want = Counter()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for s in sources:
        budget = int(target[s] + 1e-6)
        epochs = int(target[s] // total[s]) if total[s] else 0
        budget -= epochs * total[s]
        for i in sorted((i for i in left if docs[i].source == s), key=lambda i: hashlib.md5(f"mix:{i}".encode()).hexdigest()):
            copies = [texts[i]] * epochs if size[i] else []
            part = max(0, min(size[i], budget))
            budget -= part
            if part:
                copies.append(texts[i] if part == size[i] else "".join(re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", texts[i])[:part]))
            for c in copies:
                ids = [*t.encode(c, add_special_tokens=False).ids, 2]
                at, k = 0, 0
                while at < len(ids):
                    to = at + ((len(ids) - at - 1) % 1024 + 1 if k == 0 else 1024)
                    want[(i, k, at, to - at, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[at:to])))] += 1
                    at, k = to, k + 1
    rows = corpus_pipeline.run(spark, SMALL).collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got - want == Counter() and want - got == Counter() and sum(got.values()) > 100
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 1024
