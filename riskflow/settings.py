"""Run settings shared by every operator.

The defaults are the reference pipeline's own constants (target column, seed,
validation share, cut-offs) plus the knobs that only matter on a cluster
(bucket sizes for the ordered-prefix primitive, quantile accuracy).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Settings:
    # --- fixed values of the reference pipeline -------------------------------------------------
    target: str = "isFraud"
    id_col: str = "TransactionID"
    time_col: str = "TransactionDT"
    amount_col: str = "TransactionAmt"
    card_col: str = "card1"
    seed: int = 42
    valid_size: float = 0.2
    missing_threshold: float = 0.9
    variance_threshold: float = 1e-5
    max_te_card: int = 100
    top_n_features: int = 300
    top_display: int = 40
    n_folds: int = 5
    n_thresholds: int = 40
    threshold_lo: float = 0.05
    threshold_hi: float = 0.95
    decision_threshold: float = 0.5
    fn_cost: float = 5.0
    fp_cost: float = 1.0
    amount_eps: float = 1e-6
    hist_bins: int = 50
    kde_grid: int = 200
    shap_background: int = 5_000
    shap_explain: int = 2_000
    shap_top_local: int = 20
    # boosting sizes (reference defaults; tests pass smaller ones explicitly)
    gbt_trees: int = 300
    gbt_depth: int = 6
    gbt_step: float = 0.05
    gbt_subsample: float = 0.8
    gbt_feature_share: str = "0.8"
    parallel_fits: int = 4  # fits submitted at once by grids, folds and searches
    # --- cluster knobs --------------------------------------------------------------------------
    # ordered_prefix: target rows per (group, bucket) window partition
    rows_per_bucket: int = 1_000_000
    min_buckets: int = 16
    # exact quantiles: a round keeps about 4 / accuracy of the rows, until at most max_ranked distinct values are left
    bracket_accuracy: int = 10_000
    max_ranked: int = 1_000_000
    # encoders: at most this many frequent (column, value) pairs are sent to every task
    hot_values: int = 10_000
    # width of the chunked wide aggregate (codegen method size)
    agg_chunk: int = 100

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)


DEFAULT = Settings()
