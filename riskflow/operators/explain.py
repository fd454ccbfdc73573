"""Explanation (K1-K4): per-row feature contributions and their summaries.

``shapley_values`` gives the exact Shapley values of a tree ensemble's margin against a background table, from
root-to-leaf paths and counts of the background rows by which path conditions they meet; nothing is sampled. The
summaries (K2-K4) work on any long table ``(id, y, feature, value, phi)``.
"""

from __future__ import annotations

from math import comb

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.operators.trees import leaf_masks, tree_tables
from riskflow.session import cut_lineage
from riskflow.settings import DEFAULT

# Fixed values (reference): bar colours of positive / negative contributions in the local explanation.
POS_COLOR = "#e74c3c"
NEG_COLOR = "#3498db"


def feature_importance(phi: DataFrame) -> DataFrame:
    """Mean |contribution| per feature (the bar summary; also an importance table for H3/H4)."""
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))


def shap_global(phi: DataFrame, top: int = DEFAULT.top_display) -> DataFrame:
    """K2: the ``top`` features by mean |contribution|."""
    return feature_importance(phi).orderBy(F.desc("importance"), "feature").limit(top)


def shap_beeswarm(phi: DataFrame, top: int = DEFAULT.top_display) -> DataFrame:
    """K3: the (id, feature, value, contribution) points of the top features (a broadcast of <= ``top`` names)."""
    names = shap_global(phi, top).select("feature")
    return phi.join(F.broadcast(names), "feature", "inner").select("TransactionID", "feature", "value", "phi")


def shap_local(phi: DataFrame, top: int = DEFAULT.shap_top_local, id_col: str = "TransactionID") -> DataFrame:
    """K4: for the first positive row (smallest id with y = 1, else the smallest id) its ``top`` largest
    |contributions| with a sign colour and a 'feature (value)' label."""
    r = phi.agg(F.min(F.when(F.col("y") == 1, F.col(id_col))).alias("pos"), F.min(id_col).alias("any")).first()
    pick = r["pos"] if r["pos"] is not None else r["any"]
    row = phi.where(F.col(id_col) == F.lit(pick))
    w = Window.orderBy(F.desc(F.abs("phi")), "feature")  # one row's features: bounded by the feature count
    ranked = row.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return ranked.select(
        "feature", "value", F.col("phi").alias("shap_value"),
        F.when(F.col("phi") > 0, F.lit(POS_COLOR)).otherwise(F.lit(NEG_COLOR)).alias("color"),
        F.format_string("%s (%.3f)", F.col("feature"), F.col("value")).alias("label"),
        F.col("rank").cast("int").alias("rank"),
    )


def shapley_values(nodes: DataFrame, rows: DataFrame, background: DataFrame, names: list[str], features_col: str = "features",
                   id_col: str = "TransactionID") -> DataFrame:
    """K1: exact Shapley values (id, feature, value, phi) of the ensemble's margin for every row, against ``background``.

    The value of a coalition is the mean margin over the background rows whose features outside of it are their own. With
    x and b the sets of a leaf's conditions that the row and a background row meet, a hybrid reaches the leaf if every
    condition is met by one of them and it takes the a = |x \\ b| features from the row and the c = |b \\ x| ones from the
    background row. So the leaf adds (a-1)! c! / (a+c)! of its value to each of the former and subtracts a! (c-1)! / (a+c)!
    from each of the latter. Both only depend on the two masks: background rows are counted by (leaf, mask) first, the
    terms are summed for every mask that a row has, and a row looks its masks up. Work grows with rows x leaves, not with
    rows x background. Contributions of a row sum to its margin less the background's mean margin.

    The tables by tree and leaf are as large as the model; Spark broadcasts them while they are small. ``id_col`` is unique.
    """
    by_tree, by_leaf, n_trees, widest = tree_tables(nodes)
    x = rows.select(id_col, vector_to_array(features_col).alias("_x"))
    n_bg = background.count()
    met = leaf_masks(background.select(vector_to_array(features_col).alias("_x")), by_tree, n_trees)
    met = met.groupBy("leaf", F.col("mask").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    own = cut_lineage(leaf_masks(x, by_tree, n_trees), "leaf-masks")

    full = F.expr("shiftleft(1L, size(features)) - 1")
    d = own.select("leaf", F.col("mask").alias("x")).distinct().join(met, "leaf").join(by_leaf, "leaf")
    d = d.where(F.col("x").bitwiseOR(F.col("b")) == full)
    a, c = (F.bit_count(F.col(p).bitwiseAND(F.bitwise_not(F.col(q)))) for p, q in (("x", "b"), ("b", "x")))
    d = d.withColumn("a", a).withColumn("c", c).where("a + c > 0")
    # (a-1)! c! / (a+c)! = 1 / ((a+c) C(a+c-1, c)) for a > 0, by position a * (widest + 1) + c
    share = [0.0 if p == 0 else 1.0 / ((p + q) * comb(p + q - 1, q)) for p in range(widest + 1) for q in range(widest + 1)]
    table = F.array(*[F.lit(v) for v in share])
    plus = F.get(table, F.col("a") * (widest + 1) + F.col("c"))
    minus = F.get(table, F.col("c") * (widest + 1) + F.col("a"))
    d = d.withColumn("w", F.col("v") * F.col("n") / n_bg)
    d = d.select("leaf", "x", "b", (F.col("w") * plus).alias("plus"), (F.col("w") * minus).alias("minus"),
                 F.posexplode("features").alias("i", "f"))
    bit = F.expr("shiftleft(1L, i)")
    d = d.withColumn("in_x", F.col("x").bitwiseAND(bit) != 0).withColumn("in_b", F.col("b").bitwiseAND(bit) != 0)
    d = d.where("in_x != in_b").select("leaf", "x", "f", F.when(F.col("in_x"), F.col("plus")).otherwise(-F.col("minus")).alias("t"))
    terms = d.groupBy("leaf", "x", "f").agg(F.sum("t").alias("t")).groupBy("leaf", F.col("x").alias("mask")).agg(
        F.collect_list(F.struct("f", "t")).alias("terms"))  # at most one per condition

    phi = own.join(terms, ["leaf", "mask"]).select(id_col, F.explode("terms").alias("e"))
    phi = phi.groupBy(id_col, F.col("e.f").alias("f")).agg(F.sum("e.t").alias("phi"))
    phi = phi.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("f", "phi"))).alias("_phi"))
    out = x.join(phi, id_col, "left").select(id_col, "_phi", F.posexplode("_x").alias("f", "value"))
    return out.select(id_col, F.get(F.array(*[F.lit(n) for n in names]), F.col("f")).alias("feature"), "value",
                      F.coalesce(F.try_element_at("_phi", F.col("f")), F.lit(0.0)).alias("phi"))
