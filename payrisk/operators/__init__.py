"""Aggregates, histograms, samples and models: DataFrame in, DataFrame out."""

from payrisk.operators.histograms import (
    Bins,
    amount_log_histogram,
    distributions,
    histogram,
    histograms,
    probability_histogram,
    risk_score_histogram,
    tail_histogram,
)
from payrisk.operators.label_counts import (
    account_drained_cases,
    fraud_by_type,
    fraud_by_type_from_counts,
    fraud_by_type_long,
    fraud_vs_normal,
    high_value_fraud,
    label_cells,
    row_count,
)
from payrisk.operators.marts import (
    amount_buckets,
    kpi_sums,
    kpis_of_sums,
    predicted_class_counts,
    risk_level_counts,
    risk_level_summary,
    sample_kpis,
    scored_cells,
    summary_kpis,
    top_risk,
)
from payrisk.operators.models import (
    auc,
    load_model,
    model_comparison,
    save_models,
    score,
    score_transactions,
    train,
    train_all,
)
from payrisk.operators.prefix_sums import running_totals
from payrisk.operators.ranks import rank_auc
from payrisk.operators.sampling import (
    downsample_exact,
    downsample_keep_fraud,
    head_transactions,
    split_by_key,
    split_random,
    with_split,
)
from payrisk.operators.tree_columns import score_by_columns, tree_probability

__all__ = [
    "Bins",
    "account_drained_cases",
    "amount_buckets",
    "amount_log_histogram",
    "auc",
    "distributions",
    "downsample_exact",
    "downsample_keep_fraud",
    "fraud_by_type",
    "fraud_by_type_from_counts",
    "fraud_by_type_long",
    "fraud_vs_normal",
    "head_transactions",
    "high_value_fraud",
    "histogram",
    "histograms",
    "kpi_sums",
    "kpis_of_sums",
    "label_cells",
    "load_model",
    "model_comparison",
    "predicted_class_counts",
    "probability_histogram",
    "rank_auc",
    "risk_level_counts",
    "risk_level_summary",
    "risk_score_histogram",
    "row_count",
    "running_totals",
    "sample_kpis",
    "save_models",
    "score",
    "score_by_columns",
    "score_transactions",
    "scored_cells",
    "split_by_key",
    "split_random",
    "summary_kpis",
    "tail_histogram",
    "top_risk",
    "train",
    "train_all",
    "tree_probability",
    "with_split",
]
