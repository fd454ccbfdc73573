"""Exact quantiles without a buffer that holds all distinct values.

After a count, each quantile is bracketed by ``percentile_approx``, whose rank error is at most m / accuracy over m rows,
and one pass counts the rows below the bracket and estimates the distinct values inside it. Brackets that still hold more
than ``max_ranked`` are bracketed again, from the rows inside, about accuracy / 4 times narrower each round; all columns share
a round's passes. A last pass combines the values inside the brackets and a running count over them, at most about
``max_ranked`` values in a task, finds the two neighbouring order statistics, interpolated as pandas does.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.settings import DEFAULT, Settings


def _number(c: Column | str) -> Column:
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x), x)


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], s: Settings = DEFAULT) -> dict[str, list]:
    """{column: its quantiles at ``probs``} over non-NULL, non-NaN values; None where a column has none."""
    out: dict[str, list] = {}
    for at in range(0, len(cols), s.agg_chunk):
        out.update(_chunk(df, cols[at: at + s.agg_chunk], probs, s))
    return out


@dataclass
class _Slot:
    """One quantile of one column: the ranks that it needs, and the bracket [lo, hi] that holds them."""

    col: int
    prob: int
    pos: float
    lo: float
    hi: float
    below: int  # rows under lo
    inside: int  # rows in the bracket
    open: bool = True

    def holds(self):
        x = F.col(f"x{self.col}")
        return (x >= F.lit(self.lo)) & (x <= F.lit(self.hi))

    def ends(self, acc: int) -> list[float]:
        """Shares of the rows inside, wide enough for the sketch's error and for the neighbours of ``pos``."""
        p = (self.pos - self.below) / max(self.inside - 1, 1)
        slack = 2 / acc + 2 / max(self.inside, 1)
        return [max(p - slack, 0.0), min(p + slack, 1.0)]


def _narrow(d: DataFrame, slots: list[_Slot], s: Settings) -> None:
    """One round for the slots that are open."""
    todo = [w for w in slots if w.open]
    groups: dict = {}  # slots with the same bracket share a sketch
    for w in todo:
        groups.setdefault((w.col, w.lo, w.hi), []).append(w)
    acc = s.bracket_accuracy
    aggs = [F.percentile_approx(F.when(g[0].holds(), F.col(f"x{g[0].col}")), [e for w in g for e in w.ends(acc)], acc)
            .alias(f"q{i}") for i, g in enumerate(groups.values())]
    row = d.agg(*aggs).first()
    for i, g in enumerate(groups.values()):
        for j, w in enumerate(g):
            lo, hi = w.ends(acc)
            w.open = False
            if lo > 0.0 and row[f"q{i}"][2 * j] > w.lo:
                w.lo, w.open = row[f"q{i}"][2 * j], True
            if hi < 1.0 and row[f"q{i}"][2 * j + 1] < w.hi:
                w.hi, w.open = row[f"q{i}"][2 * j + 1], True
    moved = [w for w in todo if w.open]  # a bracket that stands still holds few values between its ends
    if not moved:
        return
    aggs = []
    for i, w in enumerate(moved):
        x = F.col(f"x{w.col}")
        aggs += [F.count(F.when(x < F.lit(w.lo), 1)).alias(f"b{i}"), F.count(F.when(w.holds(), 1)).alias(f"n{i}"),
                 F.approx_count_distinct(F.when(w.holds(), x)).alias(f"d{i}")]
    row = d.agg(*aggs).first()
    for i, w in enumerate(moved):
        w.below, w.inside = row[f"b{i}"], row[f"n{i}"]
        w.open = row[f"d{i}"] > s.max_ranked


def _chunk(df: DataFrame, cols: list[str], probs: list[float], s: Settings) -> dict[str, list]:
    d = df.select(*[_number(c).alias(f"x{i}") for i, c in enumerate(cols)])
    n = d.agg(*[F.count(f"x{i}").alias(f"n{i}") for i in range(len(cols))]).first()
    want = [_Slot(i, j, p * (n[i] - 1), -math.inf, math.inf, 0, n[i])
            for i in range(len(cols)) for j, p in enumerate(probs) if n[i]]
    out = {c: [None] * len(probs) for c in cols}
    if not want:
        return out
    while any(w.open for w in want):
        _narrow(d, want, s)
    inside = F.array(*[F.when(w.holds(), F.struct(F.lit(k).alias("slot"), F.col(f"x{w.col}").alias("x")))
                       for k, w in enumerate(want)])
    values = (d.select(F.explode(F.filter(inside, lambda e: e.isNotNull())).alias("e")).select("e.slot", "e.x")
              .groupBy("slot", "x").agg(F.count(F.lit(1)).alias("n")))
    run = Window.partitionBy("slot").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = F.create_map(*[F.lit(v) for k, w in enumerate(want) for v in (k, F.array(
        F.lit(math.floor(w.pos) - w.below), F.lit(math.ceil(w.pos) - w.below)).cast("array<bigint>"))])
    ranked = values.withColumn("upto", F.sum("n").over(run)).withColumn("r", ranks[F.col("slot")])
    hit = ranked.where((F.col("upto") > F.col("r")[0]) & (F.col("upto") - F.col("n") <= F.col("r")[1])).collect()
    for k, w in enumerate(want):  # at most two values per quantile come back
        got = {r["upto"]: r["x"] for r in hit if r["slot"] == k}
        low, high = math.floor(w.pos), math.ceil(w.pos)
        find = lambda rank: got[min(u for u in got if u > rank - w.below)]  # noqa: B023, E731
        a, z = find(low), find(high)
        out[cols[w.col]][w.prob] = a if low == high or a == z else (high - w.pos) * a + (w.pos - low) * z
    return out
