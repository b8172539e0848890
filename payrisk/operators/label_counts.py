"""Label analytics: grouped counts of transactions.

Each function takes featured rows, or the cells made by ``label_cells``. The cells answer
all of them from one scan; there are only as many as (type, label, flag) combinations.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.functions.numeric import rate_pct

N_ROWS = "n_rows"


def rows_in(df: DataFrame) -> Column:
    """How many transactions one input row stands for: 1, or the count of its cell."""
    return F.col(N_ROWS) if N_ROWS in df.columns else F.lit(1).cast("bigint")


def label_cells(df: DataFrame) -> DataFrame:
    keys = ("type", "isFraud", "highValueTransaction", "accountDrained")
    return df.groupBy(*keys).agg(F.count("*").alias(N_ROWS))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum(rows_in(df)), F.lit(0)).alias("count"))


def fraud_vs_normal(df: DataFrame) -> DataFrame:
    return df.groupBy("isFraud").agg(F.sum(rows_in(df)).alias("count"))


def fraud_by_type_long(df: DataFrame) -> DataFrame:
    return df.groupBy("type", "isFraud").agg(F.sum(rows_in(df)).alias("count"))


def high_value_fraud(df: DataFrame) -> DataFrame:
    return fraud_vs_normal(df.filter(F.col("highValueTransaction") == 1))


def account_drained_cases(df: DataFrame) -> DataFrame:
    return fraud_vs_normal(df.filter(F.col("accountDrained") == 1))


def fraud_by_type(df: DataFrame, order: Literal["type", "total", "rate"] = "type") -> DataFrame:
    """Labels per type side by side, with total and fraud rate; absent labels count 0."""
    n = rows_in(df)
    wide = (
        df.filter(F.col("type").isNotNull() & F.col("isFraud").isin(0, 1))
        .groupBy("type")
        .agg(
            F.sum(F.when(F.col("isFraud") == 0, n).otherwise(0)).alias("not_fraud"),
            F.sum(F.when(F.col("isFraud") == 1, n).otherwise(0)).alias("fraud"),
            F.sum(n).alias("total"),
        )
        .withColumn("fraud_rate_%", rate_pct(F.col("fraud"), F.col("total")))
    )
    by = {
        "type": [F.col("type")],
        "total": [F.col("total").desc(), F.col("type")],
        "rate": [F.col("fraud_rate_%").desc(), F.col("type")],
    }
    return wide.orderBy(*by[order])


def fraud_by_type_from_counts(
    counts: DataFrame, order: Literal["type", "total", "rate"] = "type"
) -> DataFrame:
    """The same table from saved (type, isFraud, count) rows."""
    return fraud_by_type(counts.withColumnRenamed("count", N_ROWS), order)
