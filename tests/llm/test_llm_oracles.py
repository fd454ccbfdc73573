"""Queries with an SQL form against DuckDB, and those without against brute force, on the smallest tables."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from harness import compare
from pyspark.sql import functions as F

from riskflow.llm.queries import QUERIES, SQL

ROWS = {}


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text, r.lang, r.source) for r in
            spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]


def rows(spark, name):
    if name not in ROWS:
        ROWS[name] = QUERIES[name](spark, SMALL).collect()
    return ROWS[name]


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def words(text, fold=True):
    t = (text or "").encode()
    return [w.decode() for w in (t.lower() if fold else t).split()]


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, duck_small, name):
    compare(QUERIES[name](spark, SMALL), SQL[name], duck_small)


def _profile(text):
    t = re.sub(r"[^a-z]+", " ", "".join(c.lower() if c.isalpha() else " " for c in text)) if text.isascii() else \
        re.sub(r" +", " ", "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text))
    t = re.sub(r" +", " ", f" {t} ")
    c = Counter(x for x in t if x != " ")
    c.update(t[i:i + 2] for i in range(len(t) - 1))
    c.update(t[i:i + 3] for i in range(len(t) - 2) if t[i + 1] != " ")
    return c


def _pack(g):
    v = 0
    for ch in g:
        v = v << 21 | ord(ch)
    return v


def _ranked(c):
    return [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], _pack(x[0])))[:300]]


def test_random_keys_in_small_tables(spark):
    """A key is found by the same rule in a table of one document and of many; prose has none."""
    import random

    from riskflow.llm import secret_scan

    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    prose = "the words of a plain text that nobody would call a key"
    for n in (1, 5, 19, 40):
        keys = []
        while len(keys) < n:  # keys that the battery itself calls random
            k = "".join(rng.choice(letters) for _ in range(40))
            if secret_scan.randomness(k) > 0.05:
                keys.append(k)
        rows = [(i, f"{prose} {k} {prose}") for i, k in enumerate(keys)] + [(1000 + i, f"{prose} {i} " * 3) for i in range(n)]
        got = {r.doc_id: r for r in secret_scan.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        for i, k in enumerate(keys):
            at = len(prose) + 1
            assert got[i].spans == f"random:{at}:{at + 40}", (n, k)
        assert all(got[1000 + i].spans == "" for i in range(n))


def test_random_spans_against_the_rule(spark, docs):
    """The query's random spans by a count of all candidates and decoys in one process."""
    from riskflow.llm import secret_scan as S

    found = []
    for i, text, _, _ in docs:
        base = S.base_spans(text or "")
        found += [(i, *x) for x in S.candidates(text or "", base)]
    limit = {}
    for c in range(len(S.LENGTHS)):
        own = [x for x in found if x[3] == c]
        ok = [p for p in range(S.p_bin(S.LEAST_P), S.BINS + 1) if (real := sum(x[4] >= p for x in own)) and max(
            sum(x[5] >= p for x in own), len(own) * S.CHANCE[c] * (S.LEAST_P / 10 ** (p * 10 / S.BINS - 10)) ** 0.75) <= S.FDR * real]
        limit[c] = min(ok, default=S.BINS + 1)
    want = defaultdict(set)
    for i, s, e, c, p, _ in found:
        if p >= limit[c]:
            want[i].add(f"random:{s}:{e}")
    for r in rows(spark, "op10_secret_spans"):
        assert {x for x in r.spans.split(",") if x.startswith("random")} == want[r.doc_id]


def test_language_id(spark, docs):
    total = defaultdict(Counter)
    for i, text, lang, _ in docs:
        if crc(i) % 4 != 2 and lang is not None:
            total[lang].update(_profile(text or ""))
    known = {n: {g: r for r, g in enumerate(_ranked(c))} for n, c in total.items()}
    got = {r.doc_id: r for r in rows(spark, "op3_language_id")}
    right = []
    for i, text, lang, _ in docs:
        own = _ranked(_profile(text or ""))
        away = {n: sum(abs(k[g] - r) if g in k else 300 for r, g in enumerate(own)) for n, k in known.items()}
        best = min(sorted(away), key=lambda n: away[n])
        assert got[i].held_out == (crc(i) % 4 == 2)
        assert got[i].lang_pred == best
        assert got[i].score == pytest.approx(1 - away[best] / (300 * len(own)))
        if got[i].held_out:
            right.append(got[i].lang_pred == lang)
    assert len(right) > 30 and np.mean(right) > 0.97


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = {i: [*t.encode(text or "", add_special_tokens=False).ids, 2] for i, text, _, _ in docs}
    pieces, places = defaultdict(dict), defaultdict(list)
    for r in rows(spark, "op5_best_fit_packing"):
        pieces[r.doc_id][r.piece] = r
        places[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(own)
    for i, ids in own.items():
        at = 0
        for k in range(len(pieces[i])):
            r = pieces[i][k]
            part = ids[at: at + r.length]
            assert r.start == at and len(part) == r.length
            assert r.length == 1024 or k == 0
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(map(len, own.values()))
    assert len(places) <= math.ceil(total / 1024) * 1.03 + 1


def test_secrets(spark, docs):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
                        r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    got = {r.doc_id: r for r in rows(spark, "op10_secret_spans")}
    found = 0
    for i, text, _, _ in docs:
        text = text or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
        said = [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans)]
        r = got[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in spans) for k in (0, 1, 2)]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r.spans.split(",")) | {""}
        found += len(said)
    assert found > 0


def _xx(*values):
    """Spark's xxhash64 of strings and longs."""
    import xxhash

    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed=h)
        v = h
    return h - (1 << 64) if h >> 63 else h


def _anchors(text, k=4, s=2):
    """(position, hash) of the closed syncmers of a text, by trying every k-mer."""
    t = re.findall(r"[^\x20\x09-\x0D]{1,3}", text)
    if not t:
        return []
    h = [_xx(*t[i:i + s]) for i in range(len(t) - s + 1)]
    out = []
    for i in range(len(t) - k + 1):
        inner = h[i:i + k - s + 1]
        if inner[0] == min(inner) or (inner[-1] == min(inner) and inner[-1] < min(inner[:-1])):
            out.append((i, _xx(inner[0], inner[-1])))
    return out or [(0, _xx(" ".join(t)))]


def test_fingerprints(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op8_syncmer_fingerprints")}
    down = sorted(docs, reverse=True)
    by_text, own = {}, {text or "": _anchors(text or "") for _, text, _, _ in docs}
    for k, (i, text, _, _) in enumerate(down):
        text, after = text or "", down[(k + 1) % len(down)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        said = lambda a: hashlib.sha256(",".join(f"{p}:{h & 2**64 - 1:X}" for p, h in a).encode()).hexdigest() if a else ""
        changed = _anchors(edited)
        assert (r.fingerprint, r.edited_fingerprint) == (said(own[text]), said(changed))
        for other, near in ((changed, r.near_edited), (own[after], r.near_next)):
            x, y = {h for _, h in own[text]}, {h for _, h in other}
            assert near == pytest.approx(len(x & y) / len(x | y) if x or y else 1.0)
    long = [r for r in got.values() if r.n_chars > 200]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.99
    assert len(set(by_text.values())) == len(by_text)


def test_fingerprints_see_small_changes_and_shared_passages(spark):
    from riskflow.llm import syncmers

    rng = np.random.default_rng(9)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    a = word(20_000)
    b = list(a)
    for i in rng.integers(0, len(b), 30):
        b[i] = "changed"
    c, d, passage = word(20_000), word(20_000), word(100)
    c[5000:5100] = d[15_000:15_100] = passage
    docs = spark.createDataFrame([(4, " ".join(a)), (3, " ".join(b)), (2, " ".join(c)), (1, " ".join(d))], "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    assert 0.9 < got[4].near_next < 1.0 and got[4].fingerprint != got[3].fingerprint
    assert got[2].near_next > 100 * got[3].near_next  # pieces of unrelated words meet by chance only


def _kneser_ney(train, order):
    """Dictionary model: the probability of a word after up to ``order`` - 1 words, and counts of words."""
    raw = [Counter() for _ in range(order + 1)]
    for d in train:
        padded = ["<s>", *d]
        for i in range(1, len(padded)):
            raw[1][padded[i],] += 1
            for n in range(2, order + 1):
                if i - n + 1 >= 0:
                    raw[n][tuple(padded[i - n + 1: i + 1])] += 1
    level = [None] * (order + 1)
    for n in range(1, order + 1):
        level[n] = Counter(raw[n]) if n == order else Counter(g[1:] for g in raw[n + 1])
        if 1 < n < order:
            level[n].update({g: c for g, c in raw[n].items() if g[0] == "<s>"})
    disc, sums, tails = [None], [None], [None]
    for n in range(1, order + 1):
        t = [sum(c == k for c in level[n].values()) for k in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1])
        disc.append([0] + [k - (k + 1) * y * t[k] / t[k - 1] for k in (1, 2, 3)])
        sums.append(Counter())
        tails.append(defaultdict(lambda: [0, 0, 0, 0]))
        for g, c in level[n].items():
            sums[n][g[:-1]] += c
            tails[n][g[:-1]][min(c, 3)] += 1

    def prob(context, w):
        n = len(context) + 1
        below = 1 / (len(raw[1]) + 1) if n == 1 else prob(context[1:], w)
        total = sums[n][context]
        if not total:
            return below
        c, d = level[n][(*context, w)], disc[n]
        return max(c - d[min(c, 3)], 0) / total + sum(d[k] * tails[n][context][k] for k in (1, 2, 3)) / total * below

    return prob, {g[0]: c for g, c in raw[1].items()}


@pytest.mark.parametrize("order", [2, 3])
def test_kneser_ney(spark, docs, order):
    from riskflow.llm import common, ngram_lm

    held = {i: crc(i) % 7 == 2 for i, *_ in docs}
    train = [[*words(text), "</s>"] for i, text, *_ in docs if not held[i]]
    prob, uni = _kneser_ney(train, order)
    n, v = sum(uni.values()), len(uni)
    if order == 3:
        got = {r.doc_id: r for r in rows(spark, "op9_kneser_ney_scores")}
    else:
        d = spark.read.parquet(f"{SMALL}/documents.parquet")
        d = ngram_lm.fit_and_score(d, common.crc_mod("doc_id", 7) == 2, F.col("doc_id"), order=2)
        got = {r.doc_id: r for r in d.withColumnsRenamed({"c0": "doc_id", "c1": "held_out"}).collect()}
    for i, text, _, _ in docs:
        t = [*words(text), "</s>"]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(uni.get(w, 0) > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((uni.get(w, 0) + 1) / (n + v + 1)) for w in t))
        padded = ["<s>", *t]
        assert r.score == pytest.approx(sum(math.log10(prob(tuple(padded[max(0, k - order + 1): k]), padded[k]))
                                            for k in range(1, len(padded))))
    # a context's probabilities, unknown words included, sum to one
    for a in [("<s>",), ("the",), ("nowhere",), tuple(train[0][:2])[-order + 1:], ("<s>", train[0][0])[-order + 1:]]:
        assert sum(prob(a, w) for w in uni) + prob(a, "<unknown>") == pytest.approx(1)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def _licence_terms(x):
    return re.findall(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*", x.lower())


def brute_licences(files):
    """{(row, path, text): (licence, score, origin, from_dir)} by comparing every unit with every template."""
    from riskflow.llm.licences import HEADERS, LICENCE_FILE, TEMPLATES, THRESHOLD, full_texts

    every = [(n, _licence_terms(x), False) for n, x in [*TEMPLATES, *HEADERS]] + [(n, _licence_terms(x), True) for n, x in full_texts()]
    texts = [f for f in files if f[2] is not None]
    df = Counter(w for _, _, text in texts for w in set(_licence_terms(text)))
    idf = lambda n: math.log((len(texts) + 1) / (n + 1)) + 1
    weight = {w: max(1.0, min(idf(1), idf(df[w]))) for _, t, _ in every for w in t}
    length = [math.sqrt(sum(weight[w] ** 2 for w in set(t))) for _, t, _ in every]
    own = {}
    for row, path, text in set(texts):
        seq = _licence_terms(text)
        is_file = bool(path is not None and re.match(LICENCE_FILE, path.split("/")[-1]))
        lines = [set(_licence_terms(x)) for x in text.split("\n") if x]
        norms = {}
        best = None
        for (name, t, whole), size in zip(every, length):
            tt = set(t)
            units = [(0, set(seq))] if is_file else []
            if not whole:
                units += [(k + 1, x) for k, x in enumerate(lines)]
                units += [(10**9, set(seq[i:i + len(t)])) for i, w in enumerate(seq) if w in tt]
            for k, x in units:
                dot = sum(weight[w] ** 2 for w in x & tt)
                if dot < (0.99 * THRESHOLD * size) ** 2:
                    continue  # cannot reach the threshold
                key = frozenset(x)
                if key not in norms:
                    norms[key] = math.sqrt(sum(idf(df[w]) ** 2 for w in x))
                score = round(dot / norms[key] / size, 9)
                if score >= THRESHOLD - 1e-9:
                    got = (-score, name, k)
                    best = got if best is None else min(best, got)
        if best:
            own[(row, path, text)] = best
    dirs = {}
    for (_, path, _), b in own.items():
        if path is not None and re.match(LICENCE_FILE, path.split("/")[-1]):
            d = path.rpartition("/")[0]
            dirs[d] = min(dirs.get(d, b[:2]), b[:2])
    out = {}
    for f in files:
        if f in own:
            s, name, k = own[f]
            out[f] = (name, -s, "line" if k else "file", None)
            continue
        d = None if f[1] is None else f[1].rpartition("/")[0]
        while d and d not in dirs:
            d = d.rpartition("/")[0]
        out[f] = (dirs[d][1], -dirs[d][0], "directory", d) if d is not None and d in dirs else (None, None, None, None)
    return out


def _same_licences(got, want):
    assert got[0] == want[0] and got[2:] == want[2:], (got, want)
    assert (got[1] is None) == (want[1] is None) and (got[1] is None or got[1] == pytest.approx(want[1], abs=1e-6))


def test_licences(spark, docs):
    path = {}
    for i, _, _, source in docs:
        if i % 1000 == 1:
            path[i] = f"{source}/{i // 1000}/LICENSE"
        else:
            path[i] = f"{source}/{i // 1000}/{i // 50}/" + ("LICENSE" if i % 50 == 0 else f"{i}.txt")
    want = brute_licences([(i, path[i], text) for i, text, _, _ in docs])
    got = {r.doc_id: r for r in rows(spark, "op2_licence_scan")}
    for (i, _, _), x in want.items():
        _same_licences((got[i].licence, got[i].score, got[i].origin, got[i].from_dir), x)
    assert sum(x[2] == "line" for x in want.values())


def test_licences_of_repeated_ids_headers_and_full_texts(spark):
    from riskflow.llm import licences

    gpl = dict(licences.full_texts())
    wrapped = licences.HEADERS[8][1].replace(" General", "\nGeneral").replace(" Foundation", "\n  Foundation")
    prose = " ".join(f"p{i % 377}" for i in range(900))
    files = [(5, "a/x.txt", "Released under the MIT License."), (5, "b/y.txt", "nothing here at all"), (5, "a/x.txt", "other words"),
             (6, "c/COPYING", next(iter(gpl.values()))), (7, "c/d/e/main.c", "int main"), (8, "f/z.c", f"{prose} {wrapped} {prose}"),
             (None, None, "Licensed under the Apache License, Version 2.0."), (9, None, None), (10, "LICENSE", "All rights reserved.\n" + prose),
             (11, "top.txt", ""), (12, "a/x.txt", "Released under the MIT License."), (13, "", "the of and to"), (5, "b/y.txt", "nothing here at all")]
    files += [(100 + i, f"g/{i}.txt", f"{prose[i:i + 300]} license version of the {i}") for i in range(40)]
    d = spark.createDataFrame(files, "row long, path string, text string").repartition(3)
    got = licences.scan(d.withColumn("licence", F.lit("clash"))).join(d.select(F.col("row").alias("r")).distinct(), F.col("row").eqNullSafe(F.col("r")), "left").collect()
    assert len(got) == len(files)
    want = brute_licences(files)
    from collections import defaultdict as dd

    a, b = dd(list), dd(list)
    for r in got:
        a[r.row].append((r.licence, r.score and round(r.score, 6), r.origin, r.from_dir))
    for f in files:
        x = want[f]
        b[f[0]].append((x[0], x[1] and round(x[1], 6), x[2], x[3]))
    key = lambda v: sorted(v, key=str)
    for k in b:
        assert key(a[k]) == key(b[k]), k
    assert [x[0] for x in b[5]].count("MIT") == 1 and b[8][0][0] == "GPL-3.0" and b[7][0][2] == "directory"


def test_licence_scan_of_a_very_long_text(spark):
    """Almost four megabytes of licence vocabulary in one row: linear in the words."""
    import time

    from riskflow.llm import licences

    rng = np.random.default_rng(2)
    vocabulary = _licence_terms(" ".join(x for _, x in licences.TEMPLATES)) + [f"q{i}" for i in range(300)]
    text = " ".join(rng.choice(vocabulary, 700_000)) + " Released under the MIT License."
    d = spark.createDataFrame([(1, "a/b.txt", text), (2, "a/c.txt", "plain")], "row long, path string, text string")
    at = time.time()
    got = {r.row: r for r in licences.scan(d).collect()}
    assert len(text) > 3_500_000 and got[1].licence is not None and time.time() - at < 90


def test_quality(spark):
    """On labelled documents that the fit has not seen."""
    from riskflow.llm import quality

    sf = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = {r.doc_id: r for r in quality.judge(docs, labels.filter(~out), F.col("source"), F.col("lang")).collect()}
    held = labels.filter(out).collect()

    def auc(score, mark):
        s = sorted((getattr(got[r.doc_id], score), r[mark]) for r in held)
        ranks = [k for k, (_, y) in enumerate(s) if y]
        p = len(ranks)
        return (sum(ranks) - p * (p - 1) / 2) / (p * (len(s) - p))

    assert auc("p_quality", "quality") > 0.8
    assert auc("p_toxic", "toxic") > 0.6
    clean = [r for r in held if r.quality and not r.toxic]
    assert np.mean([got[r.doc_id].kept for r in clean]) > 0.9


def _site_posterior(rows, rate):
    """{id: posterior} by dictionaries, from (id, host, path, log likelihood ratio)."""
    logit = lambda x: math.log(x / (1 - x))
    own = {i: 1 / (1 + math.exp(-(e + logit(rate)))) for i, _, _, e in rows}
    paths, hosts = defaultdict(list), defaultdict(list)
    for i, h, p, _ in rows:
        paths[(h, p)].append(own[i])
        hosts[h].append(own[i])
    n, m = len(rows), sum(own.values()) / len(rows)

    def ratio(groups, above, size_above, fitted):
        sq = sum(sum((x - np.mean(g)) ** 2 for x in g) for g in groups.values()) / max(n - len(groups), 1)
        q = sum(len(g) * (np.mean(g) - above(k)) ** 2 for k, g in groups.items())
        free = len(groups) - fitted
        if free < 0.5 or sq <= 0:
            return 1e6
        between = (q - free * sq) / max(n - sum(len(g) ** 2 / size_above(k) for k, g in groups.items()), 1e-9)
        return min(1e6, max(0.1, sq / between)) if between > 0 else 1e6

    ah = ratio(hosts, lambda k: m, lambda k: n, 1)
    ap = ratio(paths, lambda k: np.mean(hosts[k[0]]), lambda k: len(hosts[k[0]]), len(hosts))
    out = {}
    for i, h, p, e in rows:
        host = (sum(hosts[h]) - own[i] + ah * m) / (len(hosts[h]) - 1 + ah)
        r = (sum(paths[(h, p)]) - own[i] + ap * host) / (len(paths[(h, p)]) - 1 + ap)
        out[i] = 1 / (1 + math.exp(-(e + logit(min(max(r, 1e-6), 1 - 1e-6)))))
    return out, ah, ap


def test_site_levels(spark):
    """Planted sites of very different rates, most of them sparse: the levels equal those of dictionaries, the strength is far from its
    bounds, and the rate of a site moves its documents."""
    from riskflow.llm import quality

    rng = np.random.default_rng(3)
    rows, truth = [], {}
    for h in range(150):
        base = rng.beta(1.5, 1.5)
        for p in range(int(rng.integers(1, 5))):
            rate = float(np.clip(base + rng.normal(0, 0.1), 0.02, 0.98))
            for _ in range(int(rng.integers(1, 12))):
                y = rng.random() < rate
                truth[len(rows)] = (rate, y)
                rows.append((len(rows), f"h{h}" if h else None, f"p{p}" if p else None, float(rng.normal(1.5 if y else -1.5, 1.5))))
    d = spark.createDataFrame(rows, "doc_id long, c1 string, c2 string, e0 double").repartition(3)
    got = {r.doc_id: r.p_quality for r in quality.posterior(d, [0.5], ["quality"]).collect()}
    want, ah, ap = _site_posterior(rows, 0.5)
    assert got == pytest.approx(want, abs=1e-9)
    assert 0.5 < ah < 100 and 0.5 < ap < 10_000
    plain = {i: 1 / (1 + math.exp(-e)) for i, _, _, e in rows}
    loss = lambda p: -np.mean([math.log(max(1e-9, p[i] if y else 1 - p[i])) for i, (_, y) in truth.items()])
    assert loss(got) < loss(plain) - 0.01
    same = spark.createDataFrame([(i, "a", f"p{i % 9}", 0.3) for i in range(50)], "doc_id long, c1 string, c2 string, e0 double")
    assert {round(r.p_quality, 9) for r in quality.posterior(same, [0.5], ["quality"]).collect()} != set()
    assert quality.posterior(same.limit(0), [0.5], ["quality"]).count() == 0


def test_near_vectors_parts(spark):
    """List decoding is complete: every pair at the threshold shares an owned direction with the other's probes."""
    from riskflow.llm import cap_filters as C

    rng = np.random.default_rng(5)
    u = rng.standard_normal((400, 16))
    v = u + 0.03 * rng.standard_normal(u.shape)
    cos = (u * v).sum(1) / np.linalg.norm(u, axis=1) / np.linalg.norm(v, axis=1)
    pu, qu = C.products(u, 9)
    pv, qv = C.products(v, 9)
    cell, a = pu.argmax(1) * 9 + qu.argmax(1), pu.max(1) + qu.max(1)
    angle = math.acos(0.98)
    near = [k for k in range(400) if cos[k] >= 0.98]
    assert len(near) > 100
    gp, gq = (C.gaps(x, d) for x, d in zip((pv, qv), C.apart(16, 9)))
    kept = total = 0
    for k in near:
        least = math.cos(math.acos(a[k]) + angle) - 1e-9
        found = C.decode(pv[k], qv[k], least, gp[k], gq[k], 2 - 2 * 0.98 + 1e-6)[0]
        every = C.decode(pv[k], qv[k], least, gp[k], gq[k], math.inf)[0]
        assert cell[k] in set(found) and set(found) <= set(every)
        kept, total = kept + len(found), total + len(every)
    assert kept < total  # the gaps pass over directions that the inner products alone admit
    # the direction that is best for v itself is at no distance
    assert (gp.min(1) == 0).all() and (gp[np.arange(400), pv.argmax(1)] == 0).all()
