"""Grouped and ordered per-card features.

While no card has more than ``rows_per_bucket`` rows and the row keys are unique,
all features are windows inside one exchange by card. Otherwise they are computed on a narrow
projection (id, card, time, amount, keys, label) and joined back to the wide table once, by row key:

* Order-free statistics (count, mean, std, first time, group fraud rates) are
  ``groupBy`` aggregates (map-side partial aggregation) joined back; a hot card
  becomes one output row, and AQE splits a skewed join partition.
* Order-dependent ones (last three rows, previous row) never put a card in one
  task: ``ordered_prefix`` ranks each card's rows by (time, id) in parallel
  quantile buckets, then each row is sent to its own rank and the next two ranks
  (three narrow copies) and a ``groupBy(card, rank)`` yields the rolling values.

"History" statistics include the future and the row itself, as the reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions.numeric import py_str
from riskflow.operators.features import _kind
from riskflow.operators.ordered import ordered_prefix
from riskflow.settings import DEFAULT, Settings


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def card_sequence(df: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """F3 + F5 on (id, card, time, amount) rows with a non-null card: per id the mean / std (ddof 1, NULL -> 0)
    of the amount over the row and the two rows before it, and the seconds since the previous row (-1 for the
    first row and for a row without a time, which comes last)."""
    card, dt, amt, idc = s.card_col, s.time_col, s.amount_col, s.id_col
    base = df.where(F.col(card).isNotNull()).select(idc, card, dt, amt)
    r = ordered_prefix(base, order=[dt, idc], by=[card], s=s)
    # each row goes to its own rank (j = 0) and the next two ranks; the group of rank t then holds rows
    # t-2, t-1, t, and carries row t's id and the time of row t-1. Ranks past the end have no j = 0 row.
    e = r.select(card, "_rank", idc, amt, dt, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("_j"))
    g = e.groupBy(card, (F.col("_rank") + F.col("_j")).alias("_t")).agg(
        F.max(F.when(F.col("_j") == 0, F.col(idc))).alias(idc),
        F.max(F.when(F.col("_j") == 0, F.col(dt))).alias("_dt"),
        F.max(F.when(F.col("_j") == 1, F.col(dt))).alias("_prev_dt"),
        F.avg(amt).alias("card1_recent3_amt_mean"),
        F.stddev_samp(amt).alias("_r3s"),
    ).where(F.col(idc).isNotNull())
    since = F.when(F.col("_prev_dt").isNull() | F.col("_dt").isNull(), F.lit(-1.0)).otherwise((F.col("_dt") - F.col("_prev_dt")).cast("double"))
    return g.select(
        idc,
        "card1_recent3_amt_mean",
        F.coalesce(F.col("_r3s"), F.lit(0.0)).alias("card1_recent3_amt_std"),
        since.alias("time_since_last_tx_card1"),
    )


def _by_card(df: DataFrame, s: Settings) -> bool:
    """Whether all features can come from windows over single cards: whole cards (so that the text key of (card, addr1) tells the
    card), at most ``rows_per_bucket`` rows of one card, and row keys that are unique and not NULL."""
    card, idc = s.card_col, s.id_col
    if not _has(df, idc, "addr1", "P_emaildomain_provider") or _kind(df, card) != "int":
        return False
    most = df.groupBy(card).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if most is None or most > s.rows_per_bucket:
        return False
    return df.groupBy(idc).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(idc).isNull()).isEmpty()


def _in_card_windows(df: DataFrame, s: Settings) -> DataFrame:
    """F1-F9 of ``df`` from one exchange by card: the windows over (card), (card, key) and (card, provider) all find their rows there."""
    card, dt, amt, idc, y = s.card_col, s.time_col, s.amount_col, s.id_col, s.target
    prov = "P_emaildomain_provider"
    known = F.col(card).isNotNull()
    key = F.concat(py_str(card, "int"), F.lit("_"), py_str("addr1", _kind(df, "addr1")))
    in_card, in_key, in_prov = (Window.partitionBy(card, *x) for x in ([], ["card1_addr1_key"], [prov]))
    order = in_card.orderBy(F.col(dt).asc_nulls_last(), F.col(idc).asc_nulls_last())
    recent = order.rowsBetween(-2, Window.currentRow)
    own = {
        "card1_recent3_amt_mean": F.avg(amt).over(recent), "_r3s": F.stddev_samp(amt).over(recent), "_prev_dt": F.lag(dt, 1).over(order),
        "card1_txn_cnt": F.count(amt).over(in_card).cast("int"), "card1_amt_mean": F.avg(amt).over(in_card),
        "_std": F.stddev_samp(amt).over(in_card), "_first_dt": F.min(dt).over(in_card)}
    d = df.select("*", key.alias("card1_addr1_key")).select("*", *[F.when(known, v).alias(k) for k, v in own.items()])
    d = d.select("*", F.count(amt).over(in_key).cast("int").alias("card1_addr1_txn_cnt"), F.avg(amt).over(in_key).alias("card1_addr1_amt_mean"),
                 F.when(known & F.col("addr1").isNotNull(), F.avg(y).over(in_key)).alias("fr_card1_addr1"))
    d = d.select("*", F.when(known & F.col(prov).isNotNull(), F.avg(y).over(in_prov)).alias("fr_card1_Pemailprov"))
    since = F.when(F.col("_prev_dt").isNull() | F.col(dt).isNull(), F.lit(-1.0)).otherwise((F.col(dt) - F.col("_prev_dt")).cast("double"))
    d = d.withColumn("time_since_last_tx_card1", F.when(known, since))
    return d.select(
        idc, *[c for c in df.columns if c != idc], "card1_txn_cnt", "card1_amt_mean",
        F.when(known, F.coalesce(F.col("_std"), F.lit(0.0))).alias("card1_amt_std"),
        (F.col(amt) / (F.col("card1_amt_mean") + F.lit(s.amount_eps))).alias("amt_div_card1_mean"), "card1_recent3_amt_mean",
        F.when(known, F.coalesce(F.col("_r3s"), F.lit(0.0))).alias("card1_recent3_amt_std"), "time_since_last_tx_card1",
        (F.col("time_since_last_tx_card1") / 3600.0).alias("time_since_last_tx_card1_hours"),
        (F.col(dt) - F.col("_first_dt")).cast("double").alias("time_since_first_tx_card1"), "card1_addr1_key", "card1_addr1_txn_cnt",
        "card1_addr1_amt_mean", "fr_card1_addr1", "fr_card1_Pemailprov")


def behavior_features(df: DataFrame, s: Settings = DEFAULT, user: bool = True, interval: bool = True,
                      fraud_rate: bool = True, order_by_id: bool = False, fit_df: DataFrame | None = None) -> DataFrame:
    """F1-F9 added to ``df`` (F10: rows keep no order unless ``order_by_id``).

    user (F1-F4) needs amount, time and card; interval (F5-F7) time and card; fraud_rate (F8, F9) the label.
    A step whose inputs are absent passes the table through, as the reference scripts do. The fraud rates are fitted on
    ``df`` itself, or on ``fit_df`` (the training rows, say), whose groups alone then have a rate; others get NULL.
    """
    card, dt, amt, idc, y = s.card_col, s.time_col, s.amount_col, s.id_col, s.target
    user = user and _has(df, amt, dt, card)
    interval = interval and _has(df, dt, card)
    fit = df if fit_df is None else fit_df
    fraud_rate = fraud_rate and _has(fit, y)
    if not (user or interval or fraud_rate):
        return df

    if user and interval and fraud_rate and fit_df is None and _by_card(df, s):
        out = _in_card_windows(df, s)
        return out.orderBy(idc) if order_by_id else out

    keep = [c for c in [idc, card, dt, amt, "addr1", "P_emaildomain_provider", y] if c in df.columns]
    n = df.select(*keep)
    feats = n.select(*[c for c in keep if c != y])
    cols = [idc]

    # order-free per-card statistics
    if user or interval:
        aggs = []
        if user:
            aggs += [F.count(amt).cast("int").alias("card1_txn_cnt"), F.avg(amt).alias("card1_amt_mean"),
                     F.coalesce(F.stddev_samp(amt), F.lit(0.0)).alias("card1_amt_std")]
        if interval:
            aggs += [F.min(dt).alias("_first_dt")]
        per_card = n.where(F.col(card).isNotNull()).groupBy(card).agg(*aggs)
        feats = feats.join(per_card, card, "left")
    if user:
        feats = feats.withColumn("amt_div_card1_mean", F.col(amt) / (F.col("card1_amt_mean") + F.lit(s.amount_eps)))
        cols += ["card1_txn_cnt", "card1_amt_mean", "card1_amt_std", "amt_div_card1_mean"]

    # order-dependent features
    if user or interval:
        seq = card_sequence(n, s)
        feats = feats.join(seq, idc, "left")
        if user:
            cols += ["card1_recent3_amt_mean", "card1_recent3_amt_std"]
        if interval:
            feats = feats.withColumn("time_since_last_tx_card1_hours", F.col("time_since_last_tx_card1") / 3600.0)
            feats = feats.withColumn("time_since_first_tx_card1", (F.col(dt) - F.col("_first_dt")).cast("double"))
            cols += ["time_since_last_tx_card1", "time_since_last_tx_card1_hours", "time_since_first_tx_card1"]

    # (card, addr1) statistics: F4 keyed by the text key (NULL parts become 'nan'), F8 by the pair
    if "addr1" in keep and (user or fraud_rate):
        key = F.concat(py_str(card, _kind(df, card)), F.lit("_"), py_str("addr1", _kind(df, "addr1")))
        n_key = n.withColumn("card1_addr1_key", key)
        aggs = []
        if user:
            aggs += [F.count(amt).cast("int").alias("card1_addr1_txn_cnt"), F.avg(amt).alias("card1_addr1_amt_mean")]
        rate = F.avg(y).alias("_fr_ca")
        if fraud_rate and fit_df is None:
            aggs += [rate]
        feats = feats.withColumn("card1_addr1_key", key)
        if aggs:
            feats = feats.join(n_key.groupBy("card1_addr1_key").agg(*aggs), "card1_addr1_key", "left")
        if fraud_rate and fit_df is not None:
            known = fit.select(y, card, "addr1").withColumn("card1_addr1_key", key).groupBy("card1_addr1_key").agg(rate)
            feats = feats.join(known, "card1_addr1_key", "left")
        if user:
            cols += ["card1_addr1_key", "card1_addr1_txn_cnt", "card1_addr1_amt_mean"]
        if fraud_rate:
            feats = feats.withColumn(
                "fr_card1_addr1", F.when(F.col(card).isNotNull() & F.col("addr1").isNotNull(), F.col("_fr_ca"))
            )
            cols += ["fr_card1_addr1"]

    # fraud rate per (card, payer e-mail provider)
    if fraud_rate and _has(df, card, "P_emaildomain_provider"):
        pk = [card, "P_emaildomain_provider"]
        per_prov = (fit.where(F.col(card).isNotNull() & F.col("P_emaildomain_provider").isNotNull())
                    .groupBy(*pk).agg(F.avg(y).alias("fr_card1_Pemailprov")))
        feats = feats.join(per_prov, pk, "left")
        cols += ["fr_card1_Pemailprov"]

    out = df.join(feats.select(*cols), idc, "left")
    return out.orderBy(idc) if order_by_id else out


def drift_by_week(df: DataFrame, week: str = "DT_week", target: str = DEFAULT.target) -> DataFrame:
    """rows and fraud rate per week, by week."""
    if week not in df.columns or target not in df.columns:
        return df.sparkSession.createDataFrame([], f"{week} int, n_samples bigint, fraud_rate double")
    return (df.groupBy(week)
            .agg(F.count(F.lit(1)).alias("n_samples"), F.avg(target).cast("double").alias("fraud_rate"))
            .orderBy(week))


def card_mean_state(df: DataFrame, card: str = DEFAULT.card_col, amt: str = DEFAULT.amount_col
                    ) -> tuple[DataFrame, DataFrame]:
    """(card, card1_avg_amt) for cards with a non-null mean, and the one-row global mean (0 if none)."""
    state = (df.groupBy(card).agg(F.avg(amt).alias("card1_avg_amt"))
             .where(F.col("card1_avg_amt").isNotNull() & F.col(card).isNotNull()))
    glob = df.agg(F.coalesce(F.avg(amt), F.lit(0.0)).alias("global_amt_mean"))
    return state, glob
