"""Column expressions and row-wise transforms; all of them lazy and shuffle-free."""

from payrisk.functions.features import (
    account_drained,
    add_features,
    balance_error,
    dest_balance_error,
    high_value,
)
from payrisk.functions.numeric import amount_parts, rate_pct, row_hash32, stable_hash32
from payrisk.functions.risk import (
    add_amount_bucket,
    add_risk_level,
    add_risk_score,
    amount_bucket,
    project_export,
    project_risk,
    project_stream,
    risk_level,
    rule_score,
    with_risk,
)

__all__ = [
    "account_drained",
    "add_amount_bucket",
    "add_features",
    "add_risk_level",
    "add_risk_score",
    "amount_bucket",
    "balance_error",
    "amount_parts",
    "dest_balance_error",
    "high_value",
    "project_export",
    "project_risk",
    "project_stream",
    "rate_pct",
    "risk_level",
    "row_hash32",
    "rule_score",
    "stable_hash32",
    "with_risk",
]
