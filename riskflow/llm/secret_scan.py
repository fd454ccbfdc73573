"""Secret scan: fixed patterns, and a randomness test battery under false-discovery control.

Runs of 16 or more of [A-Za-z0-9+/=_-] are cut after inner '=' and, where no alphabet holds a piece, into maximal parts of
each alphabet; the parts of 16 or more characters are the candidates. Decoys are cut alike. A candidate's encoding is the smallest of hex, base 32,
base 36, base 62 and base 64 whose alphabet holds it. Four tests ask how well it agrees with independent uniform symbols
of that alphabet: chi-squared over symbols (with the exact mean and variance, as the counts are sparse), chi-squared over
character classes, runs above and below the middle of the alphabet, and lag-1 serial correlation. Fisher's method joins
them to one p-value: ordinary words fail, random keys do not.

Short runs can pass by chance, so the level that must be reached is set by length, under a share ``FDR`` of false ones: every
candidate brings a decoy of its own length, made of the text beside it without other candidates, white space and digits-only
tokens. Counts of candidates and decoys by length class and p-value, summed by Spark to a table of fixed size, give for each
length class the lowest p-value from which the false candidates expected are at most that share of those that pass.
Expected are as many as there are decoys, and not less than the candidates times the rate at which ordinary words of that
length are known to pass (``CHANCE``), so one document with a key is judged by the same rule as a million.

Defined results: a null or empty text has no spans; digits-only runs (numbers, not keys) and candidates that touch a base
span are not tested; repeated rows are counted and reported each on their own; an empty table gives an empty result;
offsets are code points, ends exclusive; other columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stage

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
HINTS = ("password", "passwd", "secret", "token", "api")
LONG = re.compile(r"[A-Za-z0-9+/=_-]{16,}")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: name, alphabet in the order of symbol values, character classes
ALPHABETS = [
    ("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"), ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")]
_CODES = [(n, {c: i for i, c in enumerate(a)}, frozenset(a)) for n, a in ALPHABETS]
FDR = 0.05
LEAST_P = 0.01    # randomness rejected at this level is never a secret
LENGTHS = (16, 20, 28, 40, 64)  # length classes begin here
#: Share of runs of ordinary words that reach LEAST_P, by length class, rounded up from prose without its blanks; it falls with p.
CHANCE = (0.15, 0.03, 0.002, 1e-4, 1e-5)
BINS = 200        # of log10 p from -10 to 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order of start and kind."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    for run in LONG.finditer(text):  # both patterns' matches lie inside such runs
        s, at = run[0], run.start()
        if "AKIA" in s:
            out += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(s) if m.end() - m.start() >= 18]
        out += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(s)]
    return sorted(out)


def encoding(s: str) -> tuple[str, dict] | None:
    have = set(s)
    for name, code, letters in _CODES:
        if have <= letters:
            return name, code
    return None


_AT_EQUALS = re.compile(r"[^=]+=*")            # padding stays with the part before it
_PLAIN = re.compile(r"[A-Za-z0-9]+=*")
_WIDE = (re.compile(r"[A-Za-z0-9+/]+=*"), re.compile(r"[A-Za-z0-9_-]+=*"))


def parts(run: str) -> list[tuple[int, int]]:
    """(start, end) of the tested parts of a run, 16 or more characters each.

    A run is cut after inner '='. Where no alphabet holds a piece, as '/' or '+' stands beside '-' or '_', its maximal
    parts in each of the two base 64 alphabets are tested, and those of letters and digits; parts may overlap.
    """
    out: set[tuple[int, int]] = set()
    for piece in _AT_EQUALS.finditer(run):
        at, s = piece.start(), piece[0]
        if encoding(s.rstrip("=")):
            out.add(piece.span())
        else:
            for form in (*_WIDE, _PLAIN):
                out |= {(at + m.start(), at + m.end()) for m in form.finditer(s)}
    return sorted(x for x in out if x[1] - x[0] >= 16)


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared, by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    v = 2 / (9 * df)
    return _upper(((x / df) ** (1 / 3) - (1 - v)) / math.sqrt(v))


def _fisher(ps: list[float]) -> float:
    """Tail of -2 sum(log p), which is chi-squared with an even number of degrees: a closed sum."""
    y = -sum(math.log(max(p, 1e-300)) for p in ps)
    term = total = 1.0
    for k in range(1, len(ps)):
        term *= y / k
        total += term
    return min(1.0, math.exp(-y) * total)


def randomness(s: str) -> float:
    """The battery's joint p-value for a run of characters; 0 where no encoding holds it."""
    s = s.rstrip("=")
    found = encoding(s) if len(s) > 3 else None
    if found is None:
        return 0.0
    _, code = found
    x = [code[c] for c in s]
    n, a = len(x), len(code)
    counts: dict[int, int] = {}
    classes = {"d": 0, "l": 0, "u": 0, "s": 0}
    for c, v in zip(s, x):
        counts[v] = counts.get(v, 0) + 1
        classes["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s"] += 1
    chi = sum(k * k for k in counts.values()) * a / n - n
    symbols = _upper((chi - (a - 1)) / math.sqrt(2 * (a - 1) * (n - 1) / n))
    share = {"d": 0, "l": 0, "u": 0, "s": 0}
    for c in code:
        share["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s"] += 1
    chi = sum((classes[k] - n * m / a) ** 2 / (n * m / a) for k, m in share.items() if m)
    kinds = _chi2_tail(chi, max(1, sum(m > 0 for m in share.values()) - 1))
    mid = (a - 1) / 2
    high = [v > mid for v in x]
    h = sum(high)
    runs = 1 + sum(p != q for p, q in zip(high, high[1:]))
    mean = (n + 1) / 2  # each neighbour differs with probability one half
    turns = math.erfc(abs(runs - mean) / math.sqrt((n - 1) / 4) / math.sqrt(2))
    mean_x = sum(x) / n
    var = sum((v - mean_x) ** 2 for v in x)
    if var == 0 or h == 0 or h == n:
        serial = 1e-10
    else:
        r = sum((p - mean_x) * (q - mean_x) for p, q in zip(x, x[1:])) / var
        serial = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))
    return _fisher([symbols, kinds, turns, serial])


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def p_bin(p: float) -> int:
    """0 (p of 1e-10 and less) to BINS (p of 1)."""
    return max(0, min(BINS, round((math.log10(max(p, 1e-300)) + 10) * BINS / 10)))


def _decoy(text: str, start: int, end: int, n: int) -> str | None:
    """``n`` characters of ordinary words beside the span."""
    for piece in (text[max(0, start - 8 * n): start], text[end: end + 8 * n]):
        words = re.findall(r"[A-Za-z0-9+/_-]+", LONG.sub(" ", piece))
        s = "".join(w for w in words if not w.isdigit())
        if len(s) >= n:
            return s[-n:]
    return None


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(start, end, length class, p bin, the decoy's p bin or -1) of the runs' parts that touch no base span."""
    out, k, reach = [], 0, 0  # reach: the furthest end of the base spans that begin before the run's end
    for run in LONG.finditer(text):
        first, touching = k, reach
        while k < len(base) and base[k][0] < run.end():
            reach, k = max(reach, base[k][2]), k + 1
        near = base[first:k]
        for start, end in parts(run[0]):
            s, start, end = run[0][start:end], run.start() + start, run.start() + end
            if s.rstrip("=").isdigit() or touching > start or any(b < end and e > start for b, _, e in near):
                continue
            decoy = _decoy(text, run.start(), run.end(), len(s))
            out.append((start, end, length_class(len(s)), p_bin(randomness(s)),
                        -1 if decoy is None else max(p_bin(randomness(decoy[x:y])) for x, y in parts(decoy) or [(0, len(s))])))
    return out


_SPAN = "array<struct<s: int, k: int, e: int>>"
_RUN = "array<struct<s: int, e: int, c: int, p: int, d: int>>"


def scan(docs: DataFrame, *more: Column) -> DataFrame:
    """The columns ``more`` with base (spans of the fixed patterns) and runs (tested candidates) of every whole text."""
    names = [f"c{i}" for i in range(len(more))]
    sent = docs.select("text", *[c.alias(n) for c, n in zip(more, names)])
    kinds = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, sent.schema.fields[1:])]
    span = pa.list_(pa.struct([(n, pa.int32()) for n in "ske"]))
    run_ = pa.list_(pa.struct([(n, pa.int32()) for n in "secpd"]))

    def run(batches):
        for b in batches:
            base, runs = [], []
            for t in b.column(0):
                text = t.as_py() or ""
                spans = base_spans(text)
                base.append([dict(zip("ske", x)) for x in spans])
                runs.append([dict(zip("secpd", x)) for x in candidates(text, spans)])
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(base, span), pa.array(runs, run_)],
                                             [*names, "base", "runs"])

    return sent.mapInArrow(run, ", ".join([*kinds, f"base {_SPAN}", f"runs {_RUN}"]))


def chance(c: int, p: int) -> float:
    """At most this share of ordinary words of length class ``c`` falls into p bin ``p`` or above."""
    return CHANCE[c] * (LEAST_P / 10 ** (10 * p / BINS - 10)) ** 0.75


def thresholds(scanned: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Per length class the lowest p bin whose candidates pass; BINS + 1 where none do.

    Reads counts by (length class, bin) only, at most len(LENGTHS) * (BINS + 1) rows.
    """
    x = scanned.select(F.explode("runs").alias("r"))
    x = x.select("r.c", F.explode(F.array(F.struct(F.col("r.p").alias("p"), F.lit(0).alias("decoy")),
                                          F.struct(F.col("r.d").alias("p"), F.lit(1).alias("decoy")))).alias("y"))
    counts = x.filter("y.p >= 0").groupBy("c", "y.p", "y.decoy").agg(F.count(F.lit(1)).alias("n")).collect()
    floor = p_bin(LEAST_P)
    out = {}
    for c in range(len(LENGTHS)):
        real, decoys, best = 0, 0, BINS + 1
        at = {(r["p"], r["decoy"]): r["n"] for r in counts if r["c"] == c}
        every = sum(n for (_, decoy), n in at.items() if not decoy)
        for p in range(BINS, floor - 1, -1):
            real += at.get((p, 0), 0)
            decoys += at.get((p, 1), 0)
            if max(decoys, every * chance(c, p)) <= fdr * real:
                best = p
        out[c] = best
    return out


def all_spans(limits: dict[int, int]) -> Column:
    """Base spans and the candidates that pass, by start and kind; of the columns base and runs."""
    least = F.create_map(*[F.lit(v) for kv in sorted(limits.items()) for v in kv])
    added = F.transform(F.filter("runs", lambda r: r["p"] >= least[r["c"]]),
                        lambda r: F.struct(r["s"].alias("s"), F.lit(3).alias("k"), r["e"].alias("e")))
    return F.array_sort(F.concat("base", added))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256 and spans of every document."""
    s = stage(scan(docs, F.col("doc_id")), "secret-runs")
    spans = s.select(F.col("c0").alias("doc_id"), "base", all_spans(thresholds(s)).alias("spans"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("bigint")
    return spans.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """All columns, with every span of the text replaced by ``mark`` and n_chars, where there is one, set anew."""
    limits = thresholds(stage(scan(docs), "secret-counts"))
    names = docs.columns
    row = docs.select(*[F.col(f"`{c}`") for c in names])
    has_n = "n_chars" in names

    def run(batches):
        for b in batches:
            texts, lengths = [], []
            for t, k in zip(b.column("text"), b.column("n_chars") if has_n else [None] * b.num_rows):
                text, n = t.as_py(), k.as_py() if has_n else None
                base = base_spans(text or "")
                spans = sorted([(s, e) for s, _, e in base] + [
                    (s, e) for s, e, c, p, _ in candidates(text or "", base) if p >= limits[c]])
                if spans:
                    out, at = [], 0
                    for s, e in spans:
                        if s >= at:
                            out += [text[at:s], mark]
                        at = max(at, e)
                    text = "".join([*out, text[at:]])
                    n = len(text)
                texts.append(text)
                lengths.append(n)
            cols = []
            for f, c in zip(b.schema, b.columns):
                if f.name == "text":
                    c = pa.array(texts, f.type)
                elif f.name == "n_chars":
                    c = pa.array(lengths, f.type)
                cols.append(c)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return row.mapInArrow(run, docs.schema)
