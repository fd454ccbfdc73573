"""Fitted trees as tables: node rows, root-to-leaf paths, the conditions that rows meet, margins after any number of trees."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One row per node: children are -1 at a leaf; rows with feature <= threshold go left; ``value`` is a leaf's share of the margin.
NODES = "tree int, node int, left int, right int, feature int, threshold double, value double"
_LEAVES = "tree int, leaves array<struct<leaf:int, value:double, conds:array<struct<f:int, lo:double, hi:double, bit:bigint>>>>"


def model_nodes(spark: SparkSession, path: str, scale: float = 2.0) -> DataFrame:
    """The node table of a boosted-tree model saved at ``path``. Spark's margin is half the log-odds, so with a ``scale`` of 2
    the leaf values add up to the log-odds of the fraud probability."""
    weights = spark.read.parquet(path + "/treesMetadata").toDF("tree", "metadata", "weights").drop("metadata")
    d = spark.read.parquet(path + "/data").toDF("tree", "nodeData").select("tree", "nodeData.*").join(weights, "tree")
    leaf = F.col("leftChild") < 0
    return d.select(
        F.col("tree").cast("int").alias("tree"), F.col("id").cast("int").alias("node"),
        F.col("leftChild").cast("int").alias("left"), F.col("rightChild").cast("int").alias("right"),
        F.when(~leaf, F.col("split.featureIndex")).cast("int").alias("feature"),
        F.when(~leaf, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(leaf, F.col("prediction") * F.col("weights") * scale).otherwise(0.0).alias("value"))


def tree_paths(nodes: DataFrame) -> list[tuple[int, float, dict]]:
    """(tree, value, {feature: (lo, hi)}) of every leaf: the rows with lo < x <= hi for each feature reach it (None: open).

    A path that no row can take is left out. The node table is as large as the model, which the driver holds anyway."""
    table = {(r["tree"], r["node"]): r for r in nodes.collect()}
    out, todo = [], [(t, n, {}) for t, n in sorted(table) if n == 0]
    while todo:
        t, n, path = todo.pop()
        r = table[(t, n)]
        if r["left"] < 0:
            out.append((t, r["value"], path))
            continue
        lo, hi = path.get(r["feature"], (None, None))
        x = r["threshold"]
        if lo is None or lo < x:
            todo.append((t, r["left"], {**path, r["feature"]: (lo, x if hi is None else min(x, hi))}))
        if hi is None or x < hi:
            todo.append((t, r["right"], {**path, r["feature"]: (x if lo is None else max(x, lo), hi)}))
    return out


def tree_tables(nodes: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """The ensemble's leaves by tree (tree, leaves with their conditions) and by leaf (leaf, v, features by condition), the number of
    trees, and the most conditions of a leaf."""
    spark = nodes.sparkSession
    paths = tree_paths(nodes)
    trees: dict[int, list] = {}
    leaves, widest = [], 0
    for k, (t, value, path) in enumerate(paths):
        conds = [(f, lo, hi, 1 << i) for i, (f, (lo, hi)) in enumerate(sorted(path.items()))]
        trees.setdefault(t, []).append((k, value, conds))
        leaves.append((k, value, [c[0] for c in conds]))
        widest = max(widest, len(conds))
    return (spark.createDataFrame(list(trees.items()), _LEAVES),
            spark.createDataFrame(leaves, "leaf int, v double, features array<int>"), max(trees, default=-1) + 1, widest)


def leaf_masks(rows: DataFrame, trees: DataFrame, n_trees: int) -> DataFrame:
    """The columns of ``rows`` but ``_x`` with (leaf, mask) for every leaf: bit i of mask says that the row meets the leaf's
    condition i. One copy of a row for each tree meets the tree's leaves, joined by the tree's number."""
    mask = F.expr("""transform(leaves, l -> struct(l.leaf as leaf, aggregate(l.conds, 0L, (m, c) -> m + if(
        (c.lo is null or _x[c.f] > c.lo) and (c.hi is null or _x[c.f] <= c.hi), c.bit, 0L)) as mask))""")
    d = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))).join(trees, "tree")
    keep = [c for c in rows.columns if c != "_x"]
    return d.select(*keep, F.explode(mask).alias("m")).select(*keep, "m.leaf", "m.mask")


def prefix_margins(nodes: DataFrame, rows: DataFrame, sizes: list[int], keep: list[str], features_col: str = "features",
                   id_col: str = "TransactionID") -> DataFrame:
    """(id, ``keep``, size, margin) of every row after the first ``size`` trees, for all ``sizes``, from one pass over the rows.

    A row finds its leaf in each tree; the leaf values of a row are summed by prefix, combined before the shuffle.
    """
    by_tree, _, n_trees, _ = tree_tables(nodes)
    if max(sizes) > n_trees:
        raise ValueError(f"the ensemble has {n_trees} trees")
    value = F.expr("""aggregate(leaves, 0.0D, (v, l) -> if(forall(l.conds, c ->
        (c.lo is null or _x[c.f] > c.lo) and (c.hi is null or _x[c.f] <= c.hi)), v + l.value, v))""")
    x = rows.select(id_col, *keep, vector_to_array(features_col).alias("_x"))
    d = x.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))).join(by_tree, "tree")
    d = d.select(id_col, *keep, "tree", value.alias("v"))
    sums = d.groupBy(id_col, *keep).agg(*[F.sum(F.when(F.col("tree") < k, F.col("v")).otherwise(0.0)).alias(f"m{k}") for k in sizes])
    each = F.array(*[F.struct(F.lit(k).alias("size"), F.col(f"m{k}").alias("margin")) for k in sizes])
    return sums.select(id_col, *keep, F.explode(each).alias("e")).select(id_col, *keep, "e.size", "e.margin")
