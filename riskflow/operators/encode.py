"""Encoders (G1-G5): frequency, target mean, cardinality gate, first-appearance codes, the app's features.

Every fitted encoder is a *state DataFrame* ``(col, key, value)`` (A4 format),
joined back to the rows (C2, a map lookup = left join + default). One exploded
aggregate builds the count and label mean of every value of every string column
in a single shuffle. ``encode`` looks all columns up at once: the rows are stored with a
number, their (number, column, value) triples meet one state table - its frequent values by
broadcast, the rest by one join - and the codes come back as one array per row, so the
number of exchanges does not depend on the number of columns.
By default the states are fitted on the rows they encode (as the reference does);
pass ``fit_df`` for a train-only fit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions import numeric as N
from riskflow.functions import text as X
from riskflow.operators.behavior import card_mean_state
from riskflow.operators.clean import string_columns
from riskflow.operators.ordered import consecutive_codes
from riskflow.session import cut_lineage
from riskflow.settings import DEFAULT, Settings


def category_stats(df: DataFrame, cols: list[str], target: str | None = None) -> DataFrame:
    """(col, key, n, mean_y) for every non-null value of every column in ``cols``: one exploded aggregate."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("key")) for c in cols])
    ycol = [F.col(target).cast("double").alias("_y")] if target else [F.lit(None).cast("double").alias("_y")]
    e = df.select(F.explode(pairs).alias("kv"), *ycol).select("kv.col", "kv.key", "_y")
    return e.where(F.col("key").isNotNull()).groupBy("col", "key").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean_y")
    )


def map_lookup(df: DataFrame, state: DataFrame, col: str, out: str, default=None) -> DataFrame:
    """``df[col].map(dict)`` = left join to the (key, value) state of ``col``, ``default`` when unseen."""
    st = state.where(F.col("col") == F.lit(col)).select(F.col("key").alias("_k"), F.col("value").alias(out))
    j = df.join(st, df[col].cast("string") == st["_k"], "left").drop("_k")
    if default is not None:
        j = j.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return j


def freq_state(df: DataFrame, cols: list[str] | None = None, stats: DataFrame | None = None) -> DataFrame:
    """G1 state: (col, key, value = count / all rows); NULLs are not counted."""
    cols = string_columns(df) if cols is None else cols
    stats = category_stats(df, cols) if stats is None else stats
    n = df.count()
    return stats.select("col", "key", (F.col("n") / F.lit(float(n))).alias("value"))


def encode(df: DataFrame, freq_cols: list[str], te_cols: list[str], freq: DataFrame | None, te: DataFrame | None,
           default: float | None = None, s: Settings = DEFAULT) -> DataFrame:
    """``<c>__freq`` for ``freq_cols`` and ``<c>__te`` for ``te_cols`` beside the columns of ``df``, from states (col, key, value).

    A value with a frequency of f takes f of its column's rows, so at most ``s.hot_values`` values have a share of
    len(cols) / hot_values or more. These, and the target states of gated columns (``max_te_card`` values each), are sent to all
    tasks, which leaves no value with a large share of the rows for the shuffled join of the others. NULL and unseen values
    get NULL frequencies and ``default`` as their target code. Rows are numbered in storage, so no column has to be unique.
    """
    cols = list(dict.fromkeys([*freq_cols, *te_cols]))
    if not cols:
        return df
    null = F.lit(None).cast("double")
    parts = [d.select("col", "key", *[(F.col("value") if i == k else null).alias(x) for i, x in enumerate(["freq", "te"])])
             for k, d in enumerate([freq, te]) if d is not None]
    table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    table = table.groupBy("col", "key").agg(F.max("freq").alias("freq"), F.max("te").alias("te"))
    number = F.create_map(*[F.lit(x) for i, c in enumerate(cols) for x in (c, i)])
    table = cut_lineage(table.where(F.col("col").isin(cols)).withColumn("ci", number[F.col("col")]).drop("col"), "encoder")
    bound = s.hot_values + s.max_te_card * len(te_cols)
    share = F.coalesce(F.col("freq") >= len(cols) / s.hot_values, F.lit(False))
    hot = next((h for h in (F.lit(True), share | F.col("te").isNotNull()) if table.where(h).count() <= bound), share)
    rare = table.where(~hot)
    src = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()), "encoder-rows")
    long = src.select("_row", F.posexplode(F.array(*[F.col(c).cast("string") for c in cols])).alias("ci", "key"))
    met = long.join(F.broadcast(table.where(hot).withColumn("hit", F.lit(True))), ["ci", "key"], "left")
    if not rare.isEmpty():
        open_ = F.col("hit").isNull() & F.col("key").isNotNull()
        far = met.where(open_).select("_row", "ci", "key").join(rare, ["ci", "key"], "left")
        met = met.where(~open_).select("_row", "ci", "freq", "te").unionByName(far.select("_row", "ci", "freq", "te"))
    codes = met.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("ci", "freq", "te"))).alias("_codes"))
    at = {c: F.get("_codes", F.lit(i)) for i, c in enumerate(cols)}  # every column has its place in every row's array
    return src.join(codes, "_row").select(
        *[F.col(f"`{c}`") for c in df.columns], *[at[c]["freq"].alias(f"{c}__freq") for c in freq_cols],
        *[F.coalesce(at[c]["te"], F.lit(default).cast("double")).alias(f"{c}__te") for c in te_cols])


def freq_encode(df: DataFrame, cols: list[str] | None = None, state: DataFrame | None = None,
                fit_df: DataFrame | None = None, s: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """G1: ``<c>__freq`` for each string column; NULL maps to NULL."""
    cols = string_columns(df) if cols is None else cols
    if state is None:
        state = freq_state(fit_df if fit_df is not None else df, cols)
    return encode(df, cols, [], state, None, s=s), state


def cardinality_gate(stats: DataFrame, cols: list[str], lo: int = 2, hi: int = DEFAULT.max_te_card) -> DataFrame:
    """Exact distinct non-null count per column and whether it lies in [lo, hi]."""
    counts = stats.groupBy("col").agg(F.count(F.lit(1)).alias("n_distinct"))
    names = stats.sparkSession.createDataFrame([(c,) for c in cols], "col string")
    j = names.join(counts, "col", "left").select("col", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))
    return j.withColumn("gated", (F.col("n_distinct") >= lo) & (F.col("n_distinct") <= hi))


def _label_mean(df: DataFrame, target: str) -> float | None:
    return df.agg(F.avg(F.col(target).cast("double"))).first()[0]


def sketched_gate(df: DataFrame, cols: list[str], hi: int = DEFAULT.max_te_card, s: Settings = DEFAULT) -> list[str]:
    """The columns that may have at most ``hi`` distinct values: one pass of mergeable sketches, no value is shuffled.

    A column is ruled out only where the estimate is two times ``hi``, twenty standard errors above it; ``cardinality_gate``
    counts the others exactly."""
    out = []
    for at in range(0, len(cols), s.agg_chunk):
        part = cols[at: at + s.agg_chunk]
        row = df.agg(*[F.approx_count_distinct(F.col(c).cast("string"), 0.05).alias(f"c{i}") for i, c in enumerate(part)]).first()
        out += [c for i, c in enumerate(part) if row[f"c{i}"] <= 2 * hi]
    return out


def target_state(df: DataFrame, target: str = DEFAULT.target, cols: list[str] | None = None,
                 s: Settings = DEFAULT, stats: DataFrame | None = None) -> tuple[DataFrame, float, list[str]]:
    """G2 state: (col, key, value = label mean) for string columns with 2..max_te_card values, and the global mean."""
    cols = string_columns(df) if cols is None else cols
    if stats is None:
        cols = sketched_gate(df, cols, s.max_te_card, s)
        if not cols:
            return df.sparkSession.createDataFrame([], "col string, key string, value double"), _label_mean(df, target), []
        stats = category_stats(df, cols, target)
    gate = cardinality_gate(stats, cols, 2, s.max_te_card)
    gated = [r["col"] for r in gate.where("gated").collect()]  # one row per text column
    g = _label_mean(df, target)
    state = stats.where(F.col("col").isin(gated)).select("col", "key", F.col("mean_y").alias("value"))
    return state, g, [c for c in cols if c in gated]


def target_encode(df: DataFrame, target: str = DEFAULT.target, cols: list[str] | None = None,
                  s: Settings = DEFAULT, fit_df: DataFrame | None = None
                  ) -> tuple[DataFrame, DataFrame, float]:
    """``<c>__te`` = label mean per value, the global mean for unseen or NULL values."""
    state, g, gated = target_state(fit_df if fit_df is not None else df, target, cols, s)
    return encode(df, [], gated, None, state, g, s), state, g


@dataclass
class Encoded:
    df: DataFrame
    freq_state: DataFrame
    te_state: DataFrame
    te_global: float
    gated: list[str]


def encode_all(df: DataFrame, target: str = DEFAULT.target, cols: list[str] | None = None, s: Settings = DEFAULT,
               fit_df: DataFrame | None = None) -> Encoded:
    """G1 + G2 from one shared exploded aggregate: ``<c>__freq`` for every text column, then ``<c>__te`` for the
    gated ones. Same result as ``freq_encode`` followed by ``target_encode`` (the frequency columns are numbers,
    so the text columns seen by the target encoder are the same)."""
    cols = string_columns(df) if cols is None else cols
    fit = fit_df if fit_df is not None else df
    if not cols:  # no text column: nothing to encode
        empty = df.sparkSession.createDataFrame([], "col string, key string, value double")
        return Encoded(df, empty, empty, _label_mean(fit, target), [])
    stats = cut_lineage(category_stats(fit, cols, target), "category-stats")
    tot = fit.agg(F.count(F.lit(1)), F.avg(F.col(target).cast("double"))).first()
    n, g = tot[0], tot[1]
    fstate = stats.select("col", "key", (F.col("n") / F.lit(float(n))).alias("value"))
    gate = {r["col"]: r for r in cardinality_gate(stats, cols, 2, s.max_te_card).collect()}  # one row per column
    gated = [c for c in cols if gate[c]["gated"]]
    tstate = stats.where(F.col("col").isin(gated)).select("col", "key", F.col("mean_y").alias("value"))
    fstate, tstate = cut_lineage(fstate, "freq-state"), cut_lineage(tstate, "te-state")
    return Encoded(encode(df, cols, gated, fstate, tstate, g, s), fstate, tstate, g, gated)


# Fixed values (reference): the token of a missing category.
MISSING_TOKEN = "__MISSING__"


def label_codes(df: DataFrame, col: str, order_col: str = DEFAULT.id_col, s: Settings = DEFAULT) -> DataFrame:
    """G4 state: (col, key, value = code) with codes 0.. in order of first appearance (smallest ``order_col``).
    NULL is encoded as the token ``__MISSING__``."""
    v = F.coalesce(F.col(col).cast("string"), F.lit(MISSING_TOKEN))
    first = df.select(v.alias("key"), F.col(order_col).alias("_first")).groupBy("key").agg(F.min("_first").alias("_first"))
    codes = consecutive_codes(first, ["_first", "key"], code_col="value", s=s)
    return codes.select(F.lit(col).alias("col"), "key", F.col("value").cast("double").alias("value"))


def label_default(state: DataFrame) -> DataFrame:
    """Per column, the code of ``__MISSING__`` if it was seen, else 0."""
    miss = state.where(F.col("key") == MISSING_TOKEN).select("col", F.col("value").alias("_m"))
    cols = state.select("col").distinct()
    return cols.join(miss, "col", "left").select("col", F.coalesce("_m", F.lit(0.0)).alias("default"))


def label_encode(df: DataFrame, col: str, state: DataFrame, out: str | None = None) -> DataFrame:
    """G4 transform: code of the value; unseen -> code of ``__MISSING__`` if known, else 0."""
    out = out or f"{col}_le"
    d = [r["default"] for r in label_default(state.where(F.col("col") == col)).collect()]
    default = d[0] if d else 0.0
    v = F.coalesce(F.col(col).cast("string"), F.lit(MISSING_TOKEN))
    tmp = df.withColumn("_lv", v)
    st = state.where(F.col("col") == col).select(F.col("key").alias("_lv"), F.col("value").alias(out))
    return tmp.join(st, "_lv", "left").withColumn(out, F.coalesce(F.col(out), F.lit(default)).cast("int")).drop("_lv")


# ---- G5: the scoring app's nine features ------------------------------------------------------

# Fixed values (reference): raw fields, features and categories of the scoring app.
MANUAL_RAW = ["TransactionAmt", "card1", "addr1", "DeviceType", "DeviceInfo", "P_emaildomain"]
MANUAL_FEATURES = ["TransactionAmt", "TransactionAmt_log", "card1", "addr1", "card1_avg_amt", "amt_to_card1_ratio",
                   "DeviceType_norm_le", "DeviceInfo_brand_le", "P_emaildomain_provider_le"]
MANUAL_CATS = ["DeviceType_norm", "DeviceInfo_brand", "P_emaildomain_provider"]


def _manual_base(df: DataFrame) -> DataFrame:
    out = df
    for c in MANUAL_RAW:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    for c in ["TransactionAmt", "card1", "addr1"]:
        out = out.withColumn(c, F.col(c).cast("string").try_cast("double"))
    return out.select(
        "*",
        X.m_device_type("DeviceType").alias("DeviceType_norm"),
        X.m_device_brand("DeviceInfo").alias("DeviceInfo_brand"),
        X.m_email_provider("P_emaildomain").alias("P_emaildomain_provider"),
    )


class ManualFeaturesModel:
    """Fitted G5 state: card means, global mean, label codes. ``transform`` adds the nine features."""

    def __init__(self, card_means: DataFrame, global_mean: float, codes: DataFrame):
        self.card_means, self.global_mean, self.codes = card_means, global_mean, codes

    def transform(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        b = _manual_base(df)
        cm = self.card_means.select(F.col("card1").cast("double").alias("card1"), "card1_avg_amt")
        b = b.join(cm, "card1", "left").withColumn(
            "card1_avg_amt", F.coalesce("card1_avg_amt", F.lit(self.global_mean)))
        b = b.withColumn("TransactionAmt_log", N.amount_log("TransactionAmt"))
        b = b.withColumn("amt_to_card1_ratio", N.amount_ratio("TransactionAmt", "card1_avg_amt", self.global_mean))
        for c in MANUAL_CATS:
            b = label_encode(b, c, self.codes)
        b = b.na.fill(0.0, subset=[c for c in MANUAL_FEATURES])
        return b.select(*keep, *[F.col(c).cast("double").alias(c) for c in MANUAL_FEATURES])

    def save(self, path: str) -> None:
        from riskflow.sources.tables import sink_state

        st = self.card_means.select(F.lit("card1").alias("col"), F.col("card1").cast("string").alias("key"),
                                    F.col("card1_avg_amt").alias("value"))
        gm = self.card_means.sparkSession.createDataFrame([("__global__", None, float(self.global_mean))],
                                                          "col string, key string, value double")
        sink_state(st.unionByName(gm).unionByName(self.codes), path)

    @staticmethod
    def load(spark, path: str) -> "ManualFeaturesModel":
        from riskflow.sources.tables import load_state

        st = load_state(spark, path)
        gm = st.where(F.col("col") == "__global__").first()["value"]
        cm = st.where(F.col("col") == "card1").select(F.col("key").cast("double").alias("card1"),
                                                     F.col("value").alias("card1_avg_amt"))
        codes = st.where(F.col("col").isin(MANUAL_CATS))
        return ManualFeaturesModel(cm, gm, codes)


def manual_features_fit(df: DataFrame, order_col: str = DEFAULT.id_col, s: Settings = DEFAULT) -> ManualFeaturesModel:
    """G5 fit: F12 card-mean state and G4 codes of the three normalised text fields (row order = ``order_col``)."""
    b = _manual_base(df)
    state, glob = card_mean_state(b, "card1", "TransactionAmt")
    g = glob.first()[0]
    codes = None
    for c in MANUAL_CATS:
        st = label_codes(b, c, order_col, s)
        codes = st if codes is None else codes.unionByName(st)
    # stored, so that a transform (each micro-batch of a stream, say) reads no training table
    return ManualFeaturesModel(cut_lineage(state, "card-means"), g, cut_lineage(codes, "codes"))
