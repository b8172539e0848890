"""Engineered features: one definition for training, batch scoring and streams."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.schema import HIGH_VALUE_AMOUNT

Drained = Literal["strict", "loose"]


def balance_error() -> Column:
    return (F.col("oldbalanceOrg") - F.col("newbalanceOrig")) - F.col("amount")


def dest_balance_error() -> Column:
    return (F.col("newbalanceDest") - F.col("oldbalanceDest")) - F.col("amount")


def high_value(null_as_zero: bool = False) -> Column:
    flag = (F.col("amount") > F.lit(float(HIGH_VALUE_AMOUNT))).cast("int")
    return F.coalesce(flag, F.lit(0)) if null_as_zero else flag


def account_drained(drained: Drained = "strict", null_as_zero: bool = False) -> Column:
    """Sender emptied. ``strict`` also asks for money there before; ``loose`` does not."""
    emptied = F.col("newbalanceOrig") == F.lit(0.0)
    if drained == "loose":
        return F.when(emptied, 1).otherwise(0)
    if drained != "strict":
        raise ValueError(f"drained must be 'strict' or 'loose', not {drained!r}")
    flag = ((F.col("oldbalanceOrg") > F.lit(0.0)) & emptied).cast("int")
    return F.coalesce(flag, F.lit(0)) if null_as_zero else flag


def add_features(
    df: DataFrame, drained: Drained = "strict", null_as_zero: bool = False
) -> DataFrame:
    """Add the two balance errors and the two flags in one projection."""
    return df.withColumns(
        {
            "balanceError": balance_error(),
            "destBalanceError": dest_balance_error(),
            "highValueTransaction": high_value(null_as_zero),
            "accountDrained": account_drained(drained, null_as_zero),
        }
    )
