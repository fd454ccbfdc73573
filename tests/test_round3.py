"""Exact contributions, narrowing quantiles, one-shuffle encoders, mergeable states, CSV types, storage layouts, footers,
prefix scores: each against brute force, pandas or the separate computation, and its plan where the plan is the point."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators import behavior as B
from riskflow.operators import clean as C
from riskflow.operators import encode as E
from riskflow.operators import explain as K
from riskflow.operators import models as M
from riskflow.operators import profile as P
from riskflow.operators import score as SC
from riskflow.operators import split as SP
from riskflow.operators import states as ST
from riskflow.operators import trees as TR
from riskflow.operators.quantiles import exact_quantiles
from riskflow.plans import pipeline as PL
from riskflow.session import cut_lineage, stage_path
from riskflow.settings import DEFAULT
from riskflow.sources import footers, layout
from riskflow.sources import tables as TB
from riskflow.sources.infer import scan_csv

TINY = DEFAULT.with_(rows_per_bucket=3, min_buckets=4)


def plan(df):
    return df._jdf.queryExecution().toString()


# ---- K1 ------------------------------------------------------------------------------------------------------------------


def _vectors(spark, rows, label=False):
    fields = [T.StructField("TransactionID", T.LongType()), T.StructField("features", VectorUDT())]
    if label:
        fields.append(T.StructField("isFraud", T.IntegerType()))
    return spark.createDataFrame([(i, Vectors.dense(x), *y) for i, x, *y in rows], T.StructType(fields))


def _walk(table, t, x):
    r = table[(t, 0)]
    while r[2] >= 0:
        r = table[(t, r[2] if x[r[4]] <= r[5] else r[3])]
    return r[6]


def _brute(table, n_trees, x, bg):
    """Shapley values by all coalitions."""
    f = lambda z: sum(_walk(table, t, z) for t in range(n_trees))
    nf = len(x)
    value = {}
    for s in itertools.product([0, 1], repeat=nf):
        value[s] = np.mean([f([a if on else b for a, b, on in zip(x, z, s)]) for z in bg])
    out = []
    for j in range(nf):
        total = 0.0
        for s in value:
            if not s[j]:
                k = sum(s)
                w = math.factorial(k) * math.factorial(nf - k - 1) / math.factorial(nf)
                total += w * (value[(*s[:j], 1, *s[j + 1:])] - value[s])
        out.append(total)
    return out, f(x) - np.mean([f(z) for z in bg])


def _random_tree(rng, t, nf, depth):
    rows, todo, n = [], [(0, depth)], 1
    while todo:
        node, d = todo.pop()
        if d == 0 or (d < depth and rng.random() < 0.2):
            rows.append((t, node, -1, -1, None, None, rng.gauss(0, 1)))
            continue
        rows.append((t, node, n, n + 1, rng.randrange(nf), float(rng.randrange(6)), 0.0))
        todo += [(n, d - 1), (n + 1, d - 1)]
        n += 2
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_shapley_equals_all_coalitions(spark, seed):
    rng = random.Random(seed)
    nf, n_trees = 5, 4
    nodes = [r for t in range(n_trees) for r in _random_tree(rng, t, nf, 5)]
    table = {(r[0], r[1]): r for r in nodes}
    draw = lambda: [float(rng.randrange(7)) for _ in range(nf)]
    xs, bg = [draw() for _ in range(12)], [draw() for _ in range(9)]
    bg += bg[:3]  # repeated background rows count each
    got = K.shapley_values(spark.createDataFrame(nodes, TR.NODES), _vectors(spark, list(enumerate(xs))),
                           _vectors(spark, list(enumerate(bg))), [f"f{i}" for i in range(nf)]).collect()
    phi = {(r["TransactionID"], r["feature"]): r for r in got}
    assert len(got) == len(phi) == len(xs) * nf
    for i, x in enumerate(xs):
        want, total = _brute(table, n_trees, x, bg)
        for j in range(nf):
            assert phi[(i, f"f{j}")]["phi"] == pytest.approx(want[j], abs=1e-9)
            assert phi[(i, f"f{j}")]["value"] == x[j]
        assert sum(phi[(i, f"f{j}")]["phi"] for j in range(nf)) == pytest.approx(total, abs=1e-9)


def test_shapley_of_one_leaf_and_no_rows(spark):
    nodes = spark.createDataFrame([(0, 0, -1, -1, None, None, 2.5)], TR.NODES)
    x = _vectors(spark, [(1, [1.0, 2.0])])
    assert [r["phi"] for r in K.shapley_values(nodes, x, x, ["a", "b"]).collect()] == [0.0, 0.0]
    assert K.shapley_values(nodes, x.limit(0), x, ["a", "b"]).collect() == []


def _fitted(spark, tmp_path, n=400, trees=6):
    rng = random.Random(3)
    rows = [(i, [rng.random(), float(rng.randrange(4)), rng.gauss(0, 1), 0.0 if rng.random() < 0.5 else rng.random()], 0) for i in range(n)]
    rows = [(i, x, int(x[0] + 0.3 * x[1] + 0.2 * x[2] > 0.9)) for i, x, _ in rows]
    df = _vectors(spark, rows, label=True).withColumn("weight", F.lit(1.0))
    s = DEFAULT.with_(gbt_trees=trees, gbt_depth=4)
    model = M.gbt(s).fit(df)
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    return df, s, model, TR.model_nodes(spark, path)


def test_shapley_of_a_fitted_model_adds_up(spark, tmp_path):
    """Sums are the row's log-odds less the background's mean, and twice the same run is the same: nothing is drawn."""
    df, _, model, nodes = _fitted(spark, tmp_path)
    rows, bg = df.where("TransactionID < 60"), df.where("TransactionID >= 200")
    odds = {r["TransactionID"]: r["z"] for r in model.transform(df).select(
        "TransactionID", (2 * vector_to_array("rawPrediction")[1]).alias("z")).collect()}
    base = np.mean([odds[i] for i in range(200, 400)])
    phi = K.shapley_values(nodes, rows, bg, list("abcd"))
    sums = {r["TransactionID"]: r["s"] for r in phi.groupBy("TransactionID").agg(F.sum("phi").alias("s")).collect()}
    assert len(sums) == 60
    for i, v in sums.items():
        assert v == pytest.approx(odds[i] - base, abs=1e-9)
    key = lambda d: sorted((r["TransactionID"], r["feature"], round(r["phi"], 12)) for r in d.collect())
    assert key(phi) == key(K.shapley_values(nodes, rows, bg, list("abcd")))


def test_prefix_scores_equal_separate_fits(spark, tmp_path):
    df, s, model, nodes = _fitted(spark, tmp_path)
    got = {(r["TransactionID"], r["size"]): r["margin"] for r in
           TR.prefix_margins(nodes, df, [1, 3, 6], ["isFraud"]).collect()}
    for k in (1, 3, 6):
        one = M.gbt(s.with_(gbt_trees=k)).fit(df).transform(df).select("TransactionID", (2 * vector_to_array("rawPrediction")[1]).alias("z"))
        for r in one.collect():
            assert got[(r["TransactionID"], k)] == pytest.approx(r["z"], abs=1e-9)
    mx = M.Matrix(df, df, list("abcd"))
    best = M.prefix_metrics(model, mx, [1, 3, 6], s)
    costs = {r["size"]: r["cost"] for r in best.collect()}
    assert set(costs) == {1, 3, 6} and costs[M.best_size(best)] == min(costs.values())


def test_search_over_full_ranges_logs_what_it_fits(spark):
    """Draws from the whole space (fewer trees only): every logged parameter is the fitted one."""
    from riskflow.plans.queries_models import CATALOG, matrix

    space = [(n, k, *((2, 4) if n == "n_estimators" else (lo, hi))) for n, k, lo, hi in M.SEARCH_SPACE]
    mx = matrix(spark, SMALL)
    log, model, best = M.random_search(mx, CATALOG, n_iter=3, space=space)
    rows = {r["iter"]: r for r in log.collect()}
    assert sorted(rows) == [1, 2, 3]
    b = rows[best.first()["iter"]]
    assert f"'maxDepth': {model.getMaxDepth()}" in b["params"] and f"'maxIter': {model.getMaxIter()}" in b["params"]
    assert model.getMinInstancesPerNode() == eval(b["params"])["minInstancesPerNode"]


# ---- quantiles, samples, density --------------------------------------------------------------------------------------------


def test_quantiles_narrow_until_few_values_are_left(spark):
    """Several rounds: coarse sketches and a bound of a few values; heavy ties and far tails stay exact."""
    rng = random.Random(7)
    x = [rng.choice([3.0, rng.gauss(0, 1), 10 ** rng.uniform(-9, 9), -rng.random()]) for _ in range(4000)]
    y = [float(rng.randrange(3)) for _ in x]
    df = spark.createDataFrame(list(zip(x, y)), "x double, y double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for limit in (1, 30, 10**6):
        got = exact_quantiles(df, ["x", "y"], probs, DEFAULT.with_(bracket_accuracy=25, max_ranked=limit))
        for c, v in (("x", x), ("y", y)):
            assert got[c] == pytest.approx([float(q) for q in np.quantile(v, probs)], rel=1e-12)


def test_subsample_reads_a_hash_cut(spark):
    df = spark.range(5000).select(F.col("id").alias("TransactionID"), F.lit("wide").alias("w")).repartition(7)
    got = {r["TransactionID"] for r in SP.subsample_n(df, 300, s=TINY).collect()}
    from riskflow.functions.hashing import hash32

    want = {r["TransactionID"] for r in df.select("TransactionID", hash32("TransactionID", "42").alias("h")).orderBy(
        "h", "TransactionID").limit(300).collect()}
    assert got == want
    stored = cut_lineage(df, "sample")
    assert "Exchange" not in plan(SP.subsample_n(stored, 300, s=TINY)).split("Physical Plan")[1]  # the wide rows are only filtered
    assert SP.subsample_n(df, 9000, s=TINY).count() == 5000
    nulls = df.withColumn("TransactionID", F.when(F.col("TransactionID") < 10, F.col("TransactionID")))
    assert SP.subsample_n(nulls, 10, s=TINY).where("TransactionID is not null").count() == 10


def test_density_of_the_rows(spark):
    rng = random.Random(8)
    v = [rng.gauss(50, 20) for _ in range(700)] + [float("nan"), None] + [60.0] * 40
    df = spark.createDataFrame([(a,) for a in v], "TransactionDT double")
    x = np.array([a for a in v if a is not None and a == a])
    h, grid = x.std(ddof=1) * len(x) ** -0.2, np.linspace(x.min(), x.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - x[None]) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    got = sorted((r["grid_i"], r["x"], r["density"]) for r in P.kde_curve(df).collect())
    assert [g[1] for g in got] == pytest.approx(list(grid)) and [g[2] for g in got] == pytest.approx(list(want), rel=1e-9, abs=1e-12)
    logs = np.log10(x[x > 0])
    got = P.kde_curve(df, log=True).collect()
    assert len(got) == 200 and min(r["x"] for r in got) == pytest.approx(logs.min())
    assert [r["density"] for r in P.kde_curve(df.where("TransactionDT = 60")).collect()] == [None]
    assert P.kde_curve(df.limit(0)).collect() == []


# ---- encoders and states ----------------------------------------------------------------------------------------------------


def _text_frame(spark, n_cols, n=300, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        row = [None if rng.random() < 0.1 else f"v{rng.randrange(3 + 40 * (k % 3))}" for k in range(n_cols)]
        if n_cols:
            row[0] = None if i % 50 == 0 else f"id{rng.randrange(10**6)}"  # id-like: above the gate
        rows.append((i // 2, i % 2, *row))  # row keys repeat
    return spark.createDataFrame(rows, "TransactionID long, isFraud int" + "".join(f", c{k} string" for k in range(n_cols)))


@pytest.mark.parametrize("hot", [10_000, 20])
def test_encoders_equal_pandas(spark, hot):
    df = _text_frame(spark, 6)
    fit = df.where("TransactionID < 100")
    for f in (None, fit):
        enc = E.encode_all(df, s=DEFAULT.with_(hot_values=hot, max_te_card=50), fit_df=f)
        pdf, base = df.toPandas(), (df if f is None else f).toPandas()
        got = enc.df.toPandas()
        assert "c0" not in enc.gated and len(enc.gated) >= 3
        key = ["TransactionID", "isFraud", *[f"c{k}" for k in range(6)]]
        for c in [f"c{k}" for k in range(6)]:
            pdf[f"{c}__freq"] = pdf[c].map(base[c].value_counts() / len(base))
            if c in enc.gated:
                pdf[f"{c}__te"] = pdf[c].map(base.groupby(c)["isFraud"].mean()).fillna(base["isFraud"].mean())
        assert list(got.columns) == list(enc.df.columns) and set(got.columns) == set(pdf.columns)
        a, b = (d.sort_values(key).reset_index(drop=True)[sorted(pdf.columns)] for d in (got, pdf))
        pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_encoder_exchanges_do_not_grow_with_the_columns(spark):
    count = []
    for n in (3, 12, 30):
        enc = E.encode_all(_text_frame(spark, n), s=DEFAULT.with_(hot_values=5, max_te_card=1))  # every join is shuffled
        text = plan(enc.df).split("Physical Plan")[1]
        count.append(text.count("Exchange"))
    assert len(set(count)) == 1 and 0 < count[0] <= 8


def test_wide_table_through_cleaning_and_encoding(spark):
    """400 columns: D1 to D4 and G1, G2 give what pandas gives."""
    rng = random.Random(6)
    names = [f"n{i}" for i in range(370)] + [f"s{i}" for i in range(30)]
    rows = []
    for i in range(120):
        num = [None if k % 20 == 0 or rng.random() < 0.3 else (5.0 if k % 20 == 1 else round(rng.gauss(0, 9), 3)) for k in range(370)]
        rows.append((i, int(rng.random() < 0.3), *num, *[None if rng.random() < 0.2 else f"t{rng.randrange(2 + k)}" for k in range(30)]))
    schema = "TransactionID long, isFraud int, " + ", ".join(f"{c} {'double' if c[0] == 'n' else 'string'}" for c in names)
    df = cut_lineage(spark.createDataFrame(rows, schema), "wide")
    out, miss, const, _ = C.clean_with_stats(df)
    assert miss == [f"n{k}" for k in range(0, 370, 20)] and const == [f"n{k}" for k in range(1, 370, 20)]
    enc = E.encode_all(out)
    pdf = pd.DataFrame(rows, columns=["TransactionID", "isFraud", *names]).drop(columns=miss + const)
    for c in pdf.columns:
        pdf[c] = pdf[c].fillna("missing" if c[0] == "s" else pdf[c].median())
    for c in [x for x in names if x[0] == "s"]:
        pdf[f"{c}__freq"] = pdf[c].map(pdf[c].value_counts() / len(pdf))
        pdf[f"{c}__te"] = pdf[c].map(pdf.groupby(c)["isFraud"].mean())
    got = enc.df.toPandas().sort_values("TransactionID").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[sorted(pdf.columns)], pdf[sorted(pdf.columns)], check_dtype=False)


def test_fraud_rates_of_training_rows(spark):
    rows = [(1, 0, 1, 1.0, 5, 1.0, "g"), (2, 1, 2, 1.0, 5, 1.0, "g"), (3, 1, 3, 1.0, 5, 1.0, "h"), (4, 1, 4, 1.0, 6, 2.0, "g")]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, card1 long, "
                                     "addr1 double, P_emaildomain_provider string")
    got = {r["TransactionID"]: r for r in B.behavior_features(df, TINY, fit_df=df.where("TransactionID <= 2")).collect()}
    assert [got[i]["fr_card1_addr1"] for i in (1, 2, 3, 4)] == [0.5, 0.5, 0.5, None]
    assert [got[i]["fr_card1_Pemailprov"] for i in (1, 2, 3, 4)] == [0.5, 0.5, None, None]
    assert [got[i]["card1_addr1_txn_cnt"] for i in (1, 2, 3, 4)] == [3, 3, 3, 1]  # order-free statistics keep all rows


def test_states_merge(spark, tmp_path):
    df = _text_frame(spark, 4).withColumn("TransactionAmt", F.when(F.col("TransactionID") % 7 > 0, F.col("TransactionID") * 0.5))
    cols = ["c0", "c1", "c2", "c3"]
    whole = ST.value_state(df, cols)
    parts = [df.where("TransactionID < 40"), df.where("TransactionID between 40 and 90"), df.where("TransactionID > 90")]
    for i, p in enumerate(parts):
        ST.save_value_state(ST.value_state(p, cols), str(tmp_path / str(i)))
    merged = ST.merge_states(*[ST.load_value_state(spark, str(tmp_path / str(i))) for i in range(3)])
    rows = lambda d: sorted((tuple(r) for r in d.collect()), key=str)
    assert merged.columns == whole.columns and rows(merged) == rows(whole)
    assert rows(ST.merge_states(whole, ST.value_state(df.limit(0), cols))) == rows(whole)
    keyed = lambda d: {(r["col"], r["key"]): r["value"] for r in d.collect()}
    assert keyed(ST.freq_view(merged)) == pytest.approx(keyed(E.freq_state(df, cols)))
    te, g, gated = E.target_state(df, cols=cols, s=DEFAULT.with_(max_te_card=50))
    got = keyed(ST.target_view(merged, DEFAULT.with_(max_te_card=50)))
    assert {k: v for k, v in got.items() if k[1] is not None} == pytest.approx(keyed(te))
    assert {k[0] for k in got if k[1] is None} == set(gated) and got[(gated[0], None)] == pytest.approx(g)
    assert keyed(ST.label_view(merged, "c1", TINY)) == keyed(E.label_codes(df, "c1", s=TINY))
    card, glob = B.card_mean_state(df, "c2")
    want = {("c2", r["c2"]): r["card1_avg_amt"] for r in card.collect()} | {("__global__", None): glob.first()[0]}
    assert keyed(ST.card_mean_view(merged, "c2")) == pytest.approx(want)
    with pytest.raises(Exception, match="state version 9"):
        ST.merge_states(whole, whole.withColumn("version", F.lit(9))).collect()


# ---- CSV types --------------------------------------------------------------------------------------------------------------

CSV = '''whole,gaps,real,flag,flag2,text,mixed,empty,big,inf,id
1,1,1.5,True,true,a,1,,9223372036854775807,1,x
-2,,2,False,,"b, c",x,NA,5,-inf,y
+3,3,1e3,TRUE,FALSE,"say ""hi""",2.5,nan,-7,Infinity,
0,NULL,.5,false,true,None,3,,0,2.5,z
'''


def test_csv_types_are_those_of_pandas(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text(CSV)
    got = scan_csv(spark, str(f))
    pdf = pd.read_csv(f)
    kinds = {"int64": "bigint", "float64": "double", "bool": "boolean"}
    flags = lambda c: all(isinstance(x, bool) for x in pdf[c].dropna())  # noqa: E731  (objects in pandas where one is missing)
    assert got.types == {c: "boolean" if flags(c) and pdf[c].notna().any() else kinds.get(str(t), "string") for c, t in pdf.dtypes.items()}
    rows = got.rows.toPandas()
    for c in pdf.columns:
        a = [None if x is None or x != x else x for x in rows[c].tolist()]
        b = [None if x is None or x != x else x for x in pdf[c].tolist()]
        assert sorted(a, key=str) == sorted(b, key=str), c
    assert got.quarantine.count() == 0
    assert TB.scan_table(spark, str(f), fmt="csv").schema == got.rows.schema


def test_csv_bad_rows_and_wide_files(spark, tmp_path):
    f = tmp_path / "b.csv"
    f.write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n13,14,15,16,17\n")
    got = scan_csv(spark, str(f))
    assert got.quarantine.count() == 2 and got.quarantine.where("a = '6'").count() == 1
    assert got.types == {"a": "bigint", "b": "bigint", "c": "double"}  # a short record lacks its last value
    assert sorted(tuple(r) for r in got.rows.collect()) == [(1, 2, 3.0), (4, 5, None), (10, 11, 12.0)]
    wide = tmp_path / "wide"
    wide.mkdir()
    for k in range(2):  # a folder of files, each with its header; one value in the second makes a column real
        (wide / f"{k}.csv").write_text(",".join(f"k{i}" for i in range(250)) + "\n" + ",".join("7.5" if k and i == 3 else "7" for i in range(250)) + "\n")
    types = scan_csv(spark, str(wide)).types
    assert types["k3"] == "double" and all(t == "bigint" for c, t in types.items() if c != "k3") and len(types) == 250


# ---- layouts and footers ----------------------------------------------------------------------------------------------------


def test_stored_stages_join_without_a_shuffle(spark):
    from riskflow.sources import fixtures as fx

    a = layout.store_bucketed(fx.tx(spark, SMALL), name="a", buckets=5)
    b = layout.store_bucketed(fx.identity(spark, SMALL), name="b", buckets=5)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = PL.merge_identity(a, b)
        text = plan(j).split("Physical Plan")[1]
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert "Exchange" in plan(PL.merge_identity(fx.tx(spark, SMALL), fx.identity(spark, SMALL))).split("Physical Plan")[1]
        ctx = layout.store_bucketed(fx.scores(spark, SMALL), name="c", buckets=5).join(a, "TransactionID")
        assert "Exchange" not in plan(ctx).split("Physical Plan")[1]
        assert j.count() == fx.tx(spark, SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    layout.drop_bucketed(b)
    assert sum(t.name.startswith("riskflow_b_") for t in spark.catalog.listTables()) == 0


def _scanned(df):
    """Rows that the file scans return when the plan runs."""
    q = df._jdf.queryExecution()
    q.executedPlan().execute().count()
    todo, total = [q.executedPlan()], 0
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        elif p.nodeName().endswith("QueryStage"):
            todo.append(p.plan())
        else:
            if p.nodeName().startswith("Scan"):
                total += p.metrics().apply("numOutputRows").value()
            todo += [p.children().apply(i) for i in range(p.children().size())]
    return total


def test_lookup_reads_few_row_groups(spark, tmp_path):
    n = 40_000
    df = spark.range(n).select((F.col("id") * 2).alias("TransactionID"), F.rand(3).alias("x")).repartition(6)
    t = layout.sink_clustered(df, str(tmp_path / "t"), rows_per_file=10_000, rows_per_group=1_000)
    got = layout.lookup(t, [2, 20_000, 79_998, 3, None])
    assert sorted(r["TransactionID"] for r in got.collect()) == [2, 20_000, 79_998]
    assert _scanned(got) <= 0.125 * n  # five row groups of forty
    absent = layout.lookup(t, [7, 40_001])  # inside the ranges, but in no bloom filter
    assert absent.count() == 0 and _scanned(absent) <= 0.05 * n
    assert layout.lookup(t, []).count() == 0 and layout.lookup(t, list(range(100))).count() == 50


def test_score_lookup_of_ids(spark):
    from riskflow.plans.queries_models import LINEAR, LINEAR_FEATURES
    from riskflow.operators import select as S

    b = PL.stages(spark, SMALL, until="behavior").behavior
    x = S.assemble(b, LINEAR_FEATURES)
    every = {r["TransactionID"]: r for r in SC.score_lookup(LINEAR, x, b).collect()}
    ids = sorted(every)[5:8]
    got = SC.score_lookup(LINEAR, x, b, ids=[*ids, -1])
    assert {r["TransactionID"]: r for r in got.collect()} == {i: every[i] for i in ids}
    assert plan(got).count("PushedFilters: [In(TransactionID") >= 1 or "In(TransactionID" in plan(got)


def test_footers_answer_a_wide_table(spark, tmp_path):
    """434 columns: every count and extreme of the stored numbers comes from the footers; no column is read."""
    cols = [F.when(F.col("id") % (k + 2) > 0, (F.col("id") * k).cast("double" if k % 2 else "bigint")).alias(f"v{k}") for k in range(430)]
    df = spark.range(300).select(*cols, F.lit(None).cast("double").alias("none"), F.lit(7).alias("seven"),
                                 F.lit("t").alias("text"), F.when(F.col("id") == 5, float("nan")).otherwise(1.0).alias("nan"))
    st = cut_lineage(df.repartition(3), "footers")
    stats = footers.table_stats(spark, stage_path(st), spark_written=True)
    assert len(stats) == 434 and sum(not s.from_footer for s in stats.values()) <= 8
    assert not stats["text"].from_footer and not stats["nan"].from_footer and stats["nan"].present == 299
    want = {r["column"]: r["missing_rate"] for r in P.missing_rate(df).collect()}
    const = {r["column"]: r["is_constant"] for r in C.constant_columns(df).collect()}
    for r in footers.stats_table(spark, stats).collect():
        assert r["missing_rate"] == pytest.approx(want[r["column"]]) and r["is_constant"] == const[r["column"]], r
    pushed = footers.pushed_down(spark, stage_path(st)).agg(*[F.count(f"v{k}") for k in range(50)], F.min("v3"), F.max("v3"))
    assert "PushedAggregation: [COUNT(v0)" in plan(pushed)
    assert footers.row_count(spark, stage_path(st)) == 300


def test_footers_of_foreign_files(spark, tmp_path):
    """Files of another writer, whose footers leave NaN out of the extremes: real columns are read."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    t = pa.table({"x": pa.array([1.0, float("nan"), 1.0]), "i": pa.array([4, 4, None]), "s": pa.array(["a", None, "a"])})
    pq.write_table(t, tmp_path / "t.parquet")
    got = footers.table_stats(spark, str(tmp_path / "t.parquet"))
    assert (got["x"].present, got["x"].nulls, got["x"].constant, got["x"].from_footer) == (2, 0, True, False)
    assert (got["i"].present, got["i"].constant, got["i"].from_footer) == (2, True, True)
    assert (got["s"].nulls, got["s"].constant) == (1, True)
    pq.write_table(t, tmp_path / "bare.parquet", write_statistics=False)
    bare = footers.table_stats(spark, str(tmp_path / "bare.parquet"))
    assert {c: (s.present, s.nulls, s.constant) for c, s in bare.items()} == {c: (s.present, s.nulls, s.constant) for c, s in got.items()}


def test_clean_with_stats_of_a_stage_and_of_a_frame(spark):
    df = PL.merged(spark, SMALL)
    a, b = C.clean_with_stats(df), C.clean_with_stats(cut_lineage(df, "clean"))
    assert a[1:3] == b[1:3] and a[0].dtypes == b[0].dtypes
    assert sorted(map(str, a[3].collect())) == sorted(map(str, b[3].collect()))


# ---- one run on fitted models ---------------------------------------------------------------------------------------------


def test_train_report(spark):
    from riskflow.plans.catalog import load_all

    reg = load_all()
    m = reg["trained_metrics"].fn(spark, SMALL).collect()
    by_file = {}
    for r in m:
        by_file.setdefault(r["src"], set()).add(r["model"])
    assert list(dict.fromkeys(r["src"] for r in sorted(m, key=lambda r: r["src_order"]))) == ["baseline", "tuned", "ensemble", "more_models"]
    assert len(by_file["ensemble"]) == 6 and "Ensemble_avg" in by_file["ensemble"]
    assert all(r["auc"] > 0.5 for r in m if r["auc"] is not None)
    seg = reg["trained_segments"].fn(spark, SMALL)
    assert {r["segment_type"] for r in seg.collect()} >= {"amount", "device"}
    n = m[0]["n"]
    assert seg.where("segment_type = 'amount'").agg(F.sum("n")).first()[0] == n
    p = reg["prefix_sizes"].fn(spark, SMALL)
    full = next(r for r in m if r["src"] == "baseline" and r["model"].startswith("GBT"))
    assert p.where("size = 10").first()["auc"] == pytest.approx(full["auc"], abs=1e-9)


# ---- stored once, one exchange ----------------------------------------------------------------------------------------------


def test_segments_read_their_rows_from_storage(spark):
    """The quantiles' passes and the metrics read one stored table, not the joins behind it."""
    from riskflow.plans.catalog import load_all

    load_all()
    from riskflow.plans import queries_eval as QE

    d = QE._vscored(spark, SMALL)
    assert stage_path(d) is not None and "Join" not in plan(d).split("Physical Plan")[1]


def _behavior_frame(spark, rows):
    return spark.createDataFrame(rows, "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, card1 long, "
                                       "addr1 double, P_emaildomain_provider string")


def test_behavior_by_one_exchange(spark):
    """Windows over cards equal the joins, NULLs included, and deal the rows once; hot cards and repeated or NULL row keys take the joins."""
    rng = random.Random(12)
    maybe = lambda v, p=0.1: None if rng.random() < p else v
    rows = [(i, int(rng.random() < 0.3), maybe(rng.randrange(400)), maybe(round(rng.uniform(1, 90), 2)), maybe(rng.randrange(15)),
             maybe(rng.choice([1.0, 2.5, 77.0, float("nan")])), maybe(rng.choice(["gmail", "other"]))) for i in range(500)]
    df = cut_lineage(_behavior_frame(spark, rows), "behavior-rows")
    by_card, joined = B.behavior_features(df), B.behavior_features(df, DEFAULT.with_(rows_per_bucket=20))
    assert by_card.columns == joined.columns
    text = plan(by_card).split("Physical Plan")[1]
    assert text.count("Exchange") == 1 and "Join" not in text and "Join" in plan(joined)
    a, b = (d.toPandas().sort_values("TransactionID").reset_index(drop=True) for d in (by_card, joined))
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-9)
    for extra in (rows[:1], [(None, *rows[0][1:])]):
        assert "Join" in plan(B.behavior_features(cut_lineage(_behavior_frame(spark, rows + extra), "behavior-rows")))


def test_model_matrix_is_stored_before_its_fits(spark):
    """The importance fit and the chosen columns read the stored matrix, with the features in their order."""
    rng = random.Random(3)
    rows = [(i, int(i % 3 == 0), float(i % 3 == 0) + rng.random(), 1.0, rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud int, a double, k double, b double")
    mx = M.model_matrix(df, DEFAULT.with_(gbt_trees=2, gbt_depth=2), importance_select=True)
    assert "Join" not in plan(mx.train) and "k" not in mx.names and "a" in mx.names
    want = {r["TransactionID"]: [r[c] for c in mx.names] for r in df.collect()}
    got = {r["TransactionID"]: r["features"].toArray().tolist() for d in (mx.train, mx.valid) for r in d.collect()}
    assert got == want and TB.feature_names(mx.train) == mx.names
