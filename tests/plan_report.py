"""Run key operators at an sf and summarise their final (adaptive) physical plans: python tests/plan_report.py [sf_dir].

Counts shuffles (Exchange), joins by strategy, windows, whole-stage-codegen spans, and prints the scan schemas,
so the scale notes in README / PLANS.md can be checked against real plans.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

from riskflow.operators import behavior as B  # noqa: E402
from riskflow.operators import encode as E  # noqa: E402
from riskflow.operators import evaluate as V  # noqa: E402
from riskflow.operators import profile as P  # noqa: E402
from riskflow.operators import split as SP  # noqa: E402
from riskflow.plans import pipeline as PL  # noqa: E402
from riskflow.session import cut_lineage, local_session  # noqa: E402
from riskflow.sources import fixtures as fx  # noqa: E402
from riskflow.sources import layout as L  # noqa: E402


def summary(name, df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [re.sub(r"^[\s:+\-|]*", "", ln) for ln in plan.splitlines()]
    count = lambda pat: sum(1 for ln in lines if re.match(pat, ln))
    row = {
        "shuffles": count(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
        "reused": count(r"ReusedExchange"),
        "single_partition_exchanges": count(r"Exchange SinglePartition"),
        "broadcast_joins": count(r"(\*\(\d+\) )?BroadcastHashJoin"),
        "sort_merge_joins": count(r"(\*\(\d+\) )?SortMergeJoin"),
        "windows": count(r"(\*\(\d+\) )?Window \["),
        "cartesian": count(r"CartesianProduct|BroadcastNestedLoopJoin"),
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
    }
    print(f"| {name} | " + " | ".join(str(v) for v in row.values()) + " |", flush=True)
    return row


def main(sf):
    spark = local_session()
    st = PL.run(PL.merged(spark, sf), until="email")
    scores = cut_lineage(fx.scores(spark, sf))
    print("| operator | shuffles | reused | single-partition | broadcast joins | sort-merge joins | windows | cartesian "
          "| codegen |")
    print("|---|---|---|---|---|---|---|---|---|")
    summary("behavior_features (F1-F9)", B.behavior_features(st.email))
    summary("card_sequence (F3, F5)", B.card_sequence(st.email))
    summary("roc_auc (J3)", V.roc_auc(scores))
    summary("roc_curve (J6)", V.roc_curve(scores))
    summary("threshold_metrics (J4)", V.threshold_metrics(scores))
    summary("stratified_split (I1)", SP.stratified_split(st.email.select("TransactionID", "isFraud")))
    summary("missing_rate (B3)", P.missing_rate(st.merged))
    summary("drift_by_week (F11)", B.drift_by_week(st.timed))
    text = E.string_columns(st.email)
    for cols in (text[:3], text):
        summary(f"encode_all (G1, G2), {len(cols)} text columns", E.encode_all(st.email, cols=cols).df)
    a, b = L.store_bucketed(fx.tx(spark, sf), name="tx"), L.store_bucketed(fx.identity(spark, sf), name="identity")
    summary("merge_identity (C1) on bucketed stages", PL.merge_identity(a, b))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
