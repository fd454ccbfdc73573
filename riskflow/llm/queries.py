"""The registered queries of the corpus operators: (spark, sf_dir) -> DataFrame, and DuckDB text where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import (cap_filters, collocations, lang_id, licences, minhash_join, mix, ngram_lm, packing, periodic_runs,
                          quality, secret_scan, substring_dedup, syncmers)
from riskflow.llm.common import WORD, crc_mod, read

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_cap_filter_near_duplicates(spark, sf_dir) -> DataFrame:
    """Components of the vectors of a label with a cosine of 0.98 or more."""
    return cap_filters.near_vectors(read(spark, sf_dir, "embeddings"), 0.98)


SQL["op1_cap_filter_near_duplicates"] = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding, label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings),
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM e WHERE ok),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.98),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM pairs GROUP BY a),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, least(e.vec_id, coalesce(c.component_id, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(c.component_id, e.vec_id) AS kept
FROM e LEFT JOIN n ON e.vec_id = n.vec_id LEFT JOIN c ON e.vec_id = c.vec_id
"""


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files (row, path, text): their source is the root, ids give directories and names.

    Every 50th id is its directory's LICENSE, every 1,000th plus one that of the directory above.
    """
    i = F.col("doc_id")
    up = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(i / 1000).cast("string"))
    path = (F.when(i % 1000 == 1, F.concat(up, F.lit("/LICENSE")))
            .when(i % 50 == 0, F.concat(up, F.lit("/"), F.floor(i / 50).cast("string"), F.lit("/LICENSE")))
            .otherwise(F.concat(up, F.lit("/"), F.floor(i / 50).cast("string"), F.lit("/"), i.cast("string"), F.lit(".txt"))))
    return docs.select(F.coalesce(i, F.xxhash64("text")).alias("row"), path.alias("path"), "text")


@query
def op2_licence_scan(spark, sf_dir) -> DataFrame:
    """Every document's licence from its own lines or the nearest directory's licence file."""
    return licences.scan(document_files(read(spark, sf_dir, "documents"))).withColumnRenamed("row", "doc_id")


@query
def op3_language_id(spark, sf_dir) -> DataFrame:
    """Languages by rank-order profiles, learned from the documents outside the held-out quarter."""
    docs = read(spark, sf_dir, "documents")
    held = crc_mod("doc_id", 4) == 2
    known = lang_id.profiles(docs, ~held)
    d = lang_id.predict(docs, known, F.col("doc_id"), held)
    return d.select(F.col("c0").alias("doc_id"), F.col("c1").alias("held_out"), "lang_pred", "score")


@query
def op4_source_mix(spark, sf_dir) -> DataFrame:
    """The mix's targets per source and the words taken of each document."""
    d = mix.mix_plan(read(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "source_size", "target", "taken")


SQL["op4_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, source_size * 2 AS cap
      FROM s),
p AS (SELECT *, coalesce(sum(cap) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before,
        sum(source_size) OVER () AS total, sum(w) OVER () AS w_total FROM w
      WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT *, CAST(total AS DOUBLE) * 1.5::DOUBLE - CAST(cap_before AS DOUBLE) AS rest, CAST(w_total - w_before AS DOUBLE) AS w_rest FROM p),
c AS (SELECT *, rest * w / w_rest >= cap AS capped FROM r),
f AS (SELECT *, max(CASE WHEN NOT capped THEN rest END) OVER () AS rest_free,
        max(CASE WHEN NOT capped THEN w_rest END) OVER () AS w_free FROM c),
t AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE rest_free * w / w_free END AS target FROM f),
x AS (SELECT d.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN CAST(floor(target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
        CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS taken
FROM x
"""


@query
def op5_best_fit_packing(spark, sf_dir) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op6_hierarchical_quality(spark, sf_dir) -> DataFrame:
    """Quality and toxicity of every document: evidence, and rates of its source and of the source's language."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality.judge(docs, labels, F.col("source"), F.col("lang"))


@query
def op7_minhash_near_duplicates(spark, sf_dir) -> DataFrame:
    """Components of documents whose sets of two-word shingles have a similarity of 0.8 or more."""
    return minhash_join.near_duplicates(read(spark, sf_dir, "documents"), words=2, percent=80)


SQL["op7_minhash_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] END) AS g FROM w),
c AS (SELECT g, min(doc_id) AS rep FROM (SELECT doc_id, list_sort(g) AS g FROM g WHERE len(g) > 0) GROUP BY g),
u AS (SELECT rep, len(g) AS n, unnest(g) AS s FROM c),
pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM u a JOIN u b ON a.s = b.s AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs UNION SELECT rep, rep FROM c),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a),
rows AS (SELECT g.doc_id, CAST(len(g.g) AS BIGINT) AS n_shingles, coalesce(comp.component_id, g.doc_id) AS component_id
  FROM g LEFT JOIN c ON list_sort(g.g) = c.g LEFT JOIN comp ON comp.rep = c.rep)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM rows
"""


@query
def op8_syncmer_fingerprints(spark, sf_dir) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    return syncmers.fingerprints(read(spark, sf_dir, "documents"))


@query
def op9_kneser_ney_scores(spark, sf_dir) -> DataFrame:
    """Log probabilities of every document under the model of those that are not held out."""
    d = ngram_lm.fit_and_score(read(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2, F.col("doc_id"))
    return d.select(F.col("c0").alias("doc_id"), F.col("c1").alias("held_out"), "n_tokens", "n_known", "train_tokens",
                    "base_score", "score")


@query
def op10_secret_spans(spark, sf_dir) -> DataFrame:
    """Spans of secrets in every document."""
    return secret_scan.find(read(spark, sf_dir, "documents"))


@query
def op11_substring_dedup(spark, sf_dir) -> DataFrame:
    """Words left in every document when windows of 35 words that occur elsewhere are cut."""
    d = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"), F.col("doc_id"), window=35)
    return d.select(F.col("c0").alias("doc_id"), "n_words", "n_removed",
                    F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL["op11_substring_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT rid, unnest(range(len(w) - 34)) AS s,
        unnest(list_transform(range(len(w) - 34), lambda i: md5(array_to_string(w[i + 1:i + 35], ' ')))) AS h FROM d),
r AS (SELECT rid, s FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT rid, unnest(range(s, s + 35)) AS i FROM r),
x AS (SELECT rid, unnest(range(len(w))) AS i, unnest(w) AS w FROM d),
k AS (SELECT x.rid, count(*) AS n, string_agg(x.w, ' ' ORDER BY x.i) AS t FROM x LEFT JOIN gone USING (rid, i)
      WHERE gone.i IS NULL GROUP BY x.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.t, '')) AS kept_sha256 FROM d LEFT JOIN k USING (rid)
"""


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the contract's repeats: in a tenth of the documents the words from a on repeat with period p."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"), F.floor(h / 10).alias("g"))
    w = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    repeats = F.expr("""array_join(transform(sequence(0L, n - 1), i ->
        element_at(w, cast(if(i < a, i, a + (i - a) % p) as int) + 1)), ' ')""")
    d = d.withColumn("w", F.when(h % 10 == 0, w)).withColumn("n", F.size("w").cast("long"))
    d = d.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    d = d.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    return d.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), repeats).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark, sf_dir) -> DataFrame:
    """Every document's periodic runs, its longest one and the text without their repeats."""
    d = periodic_runs.collapse(planted_periods(read(spark, sf_dir, "documents")), F.col("doc_id"))
    best = F.expr("""aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (x, y) ->
        if(x is null or y.length > x.length, y, x))""")
    said = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), '')")
    d = d.withColumn("best", best)
    return d.select(F.col("c0").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
                    "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                    F.sha2(said.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


SQL["op12_periodic_runs"] = r"""
WITH d0 AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT range AS b, list_reduce(list_prepend(range, range(8)), lambda c, k: CASE WHEN c % 2 = 1
        THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256)),
tab AS (SELECT list(v ORDER BY b) AS v FROM t),
d1 AS (SELECT rid, doc_id, w, len(w) AS n, xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: ascii(c)::BIGINT)),
        lambda c, x: xor(c // 256, tab.v[xor(c % 256, x) + 1])), 4294967295) AS h FROM d0, tab),
d2 AS (SELECT *, h // 10 AS g FROM d1),
d3 AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM d2),
d4 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM d3),
d AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: w[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END) + 1]) ELSE w END AS w FROM d4),
x AS (SELECT rid, n, unnest(range(n)) AS i, unnest(w) AS w FROM d),
pairs AS (SELECT a.rid, b.i - a.i AS q, a.i FROM x a JOIN x b ON a.rid = b.rid AND a.w = b.w AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS k FROM pairs),
st AS (SELECT rid, q, min(i) AS s, max(i) + 1 + q AS e FROM islands GROUP BY rid, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT rid, s, e, min(q) AS q FROM st GROUP BY rid, s, e),
said AS (SELECT rid, count(*) AS n_runs, sha256(string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256,
  arg_min({'s': s, 'l': e - s, 'q': q}, (s - e, s, q)) AS best FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(s + q, e)) AS i FROM runs),
kept AS (SELECT x.rid, string_agg(x.w, ' ' ORDER BY x.i) AS t FROM x LEFT JOIN gone USING (rid, i) WHERE gone.i IS NULL GROUP BY x.rid)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
  best.l * 1000 // best.q AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
  sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN said USING (rid) LEFT JOIN kept USING (rid)
"""


@query
def op13_phrase_collocations(spark, sf_dir) -> DataFrame:
    """Every language's first 2000 phrases."""
    return collocations.collocations(read(spark, sf_dir, "documents"), min_count=30, share=80, top=2000)


SQL["op13_phrase_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(len(w) - k + 1), lambda i: w[i + 1:i + k])) AS g
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT c.lang, c.g, c.a, t AS cut, x.a AS l, y.a AS r, 2000000::HUGEINT * c.a // (x.a + y.a) AS score
      FROM (SELECT *, unnest(range(1, k)) AS t FROM f WHERE k > 1) c
      JOIN f x ON x.lang = c.lang AND x.g = c.g[:t] JOIN f y ON y.lang = c.lang AND y.g = c.g[t + 1:]),
b AS (SELECT lang, g, a, unnest(arg_min({'l': l, 'r': r, 'score': score}, (score, cut))) FROM c GROUP BY lang, g, a),
i AS (SELECT lang, a, g[s + 1:s + m] AS g FROM (SELECT *, unnest(range(k - m + 1)) AS s FROM
        (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2))),
o AS (SELECT lang, g, max(a) AS most FROM i GROUP BY lang, g),
z AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM b LEFT JOIN o ON o.lang = b.lang AND o.g = b.g
      WHERE o.most IS NULL OR 100 * o.most::HUGEINT < 80 * b.a::HUGEINT)
SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n.n,
  CAST(score AS BIGINT) AS score FROM z JOIN n ON n.lang = z.lang
QUALIFY rank <= 2000
"""
