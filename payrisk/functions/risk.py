"""Probability -> 0-100 score -> level, the rule score, and the column sets written out."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.schema import (
    AMOUNT_BUCKET_STARTS,
    AMOUNT_BUCKETS,
    BALANCE_ERROR_LIMIT,
    HIGH_VALUE_AMOUNT,
    RISK_CUTS,
    RISK_LEVELS,
    RULE_POINTS,
    RULE_POINTS_CAP,
    SCORED_SCHEMA,
)


def risk_level(score: Column) -> Column:
    """Level of a 0-100 score; NULL and NaN have no level."""
    low, medium, high = RISK_LEVELS
    return (
        F.when(score.isNull() | F.isnan(score), F.lit(None).cast("string"))
        .when(score <= F.lit(float(RISK_CUTS[0])), low)
        .when(score <= F.lit(float(RISK_CUTS[1])), medium)
        .otherwise(high)
    )


def add_risk_score(df: DataFrame) -> DataFrame:
    """Add ``fraud_probability`` (taken from the model's vector if absent) and ``risk_score``."""
    if "fraud_probability" not in df.columns:
        df = df.withColumn("fraud_probability", vector_to_array("probability")[1])
    return df.withColumn("risk_score", F.col("fraud_probability") * F.lit(100.0))


def add_risk_level(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_level", risk_level(F.col("risk_score")))


def with_risk(df: DataFrame) -> DataFrame:
    """Scored rows with probability, score and level."""
    return add_risk_level(add_risk_score(df))


def amount_bucket(amount: Column) -> Column:
    """Left-closed amount band; negative, NULL, NaN and infinite amounts have none."""
    ends = [*AMOUNT_BUCKET_STARTS[1:], float("inf")]
    band = F.when(amount < F.lit(float(AMOUNT_BUCKET_STARTS[0])), F.lit(None).cast("string"))
    for end, label in zip(ends, AMOUNT_BUCKETS):
        band = band.when(amount < F.lit(float(end)), label)
    return band


def add_amount_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_bucket", amount_bucket(F.col("amount")))


def rule_points() -> Column:
    """Integer points of the transparent rules, capped. A NULL condition scores nothing."""
    far_off = F.lit(float(BALANCE_ERROR_LIMIT))
    fired = {
        "high_value_flag": F.col("highValueTransaction") == 1,
        "drained_flag": F.col("accountDrained") == 1,
        "large_amount": F.col("amount") > F.lit(float(HIGH_VALUE_AMOUNT)),
        "balance_error": F.abs(F.col("balanceError")) > far_off,
        "dest_balance_error": F.abs(F.col("destBalanceError")) > far_off,
    }
    total = F.lit(0)
    for rule, points in RULE_POINTS.items():
        total = total + F.when(fired[rule], points).otherwise(0)
    return F.least(total, F.lit(RULE_POINTS_CAP))


def rule_score(df: DataFrame) -> DataFrame:
    """Score featured rows by rules: the same output columns as a trained model."""
    probability = rule_points().cast("double") / F.lit(100.0)
    scored = df.withColumn("fraud_probability", probability)
    scored = scored.withColumn(
        "prediction", (F.col("fraud_probability") >= F.lit(0.5)).cast("double")
    )
    return with_risk(scored)


def project_risk(df: DataFrame) -> DataFrame:
    return df.select("prediction", "fraud_probability", "risk_score", "risk_level")


def project_export(df: DataFrame, *extra: str) -> DataFrame:
    """Columns of the exported scored table, led by any extra ones asked for."""
    return df.select(*extra, *SCORED_SCHEMA.fieldNames())


def project_stream(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        *extra, "step", "type", "amount", "prediction", "fraud_probability", "risk_score", "risk_level"
    )
