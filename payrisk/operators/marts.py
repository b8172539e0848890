"""BI marts over scored transactions.

Every mart takes scored rows, or the cells made by ``scored_cells``: counts and exact
amount sums per (prediction, risk level, amount bucket). All the marts are sums over
those cells, so a job that needs several reads the scored table once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.functions.numeric import (
    AMOUNT_PARTS,
    amount_from_parts,
    amount_parts,
    priced,
    rate_pct,
)
from payrisk.functions.risk import amount_bucket
from payrisk.operators.label_counts import N_ROWS, rows_in
from payrisk.schema import AMOUNT_BUCKETS, RISK_LEVELS, TOP_RISK_ROWS


TOP_GROUPS = 1_000


def _priced(df: DataFrame) -> Column:
    """How many of the rows carry an amount (means leave out the others)."""
    if N_ROWS in df.columns:
        return F.col("n_amounts")
    return F.when(priced(F.col("amount")), F.lit(1).cast("bigint")).otherwise(0)


def _amount_parts(df: DataFrame) -> tuple[Column, ...]:
    if N_ROWS in df.columns:
        return tuple(F.col(name) for name in AMOUNT_PARTS)
    return amount_parts(F.col("amount"))


def _total(df: DataFrame, condition: Column | None = None) -> Column:
    """Exact sum of the amounts (where a condition holds); NULL if there is none."""
    chosen = (p if condition is None else F.when(condition, p) for p in _amount_parts(df))
    return amount_from_parts(*(F.sum(part) for part in chosen))


def _bucket(df: DataFrame) -> Column:
    known = "amount_bucket" in df.columns
    return F.col("amount_bucket") if known else amount_bucket(F.col("amount"))


def scored_cells(df: DataFrame) -> DataFrame:
    """One row per (prediction, risk level, amount bucket): a few dozen at any input size."""
    return df.groupBy("prediction", "risk_level", _bucket(df).alias("amount_bucket")).agg(
        F.count("*").alias(N_ROWS),
        F.sum(_priced(df)).alias("n_amounts"),
        *[F.sum(p).alias(n) for p, n in zip(_amount_parts(df), AMOUNT_PARTS)],
    )


def kpi_sums(df: DataFrame) -> list[Column]:
    """What the headline figures are made of: aggregates that a pass over the rows can carry."""
    n = rows_in(df)
    fraud = F.col("prediction") == 1
    _, medium, high = RISK_LEVELS
    parts = dict(zip(AMOUNT_PARTS, _amount_parts(df)))
    return [
        F.coalesce(F.sum(n), F.lit(0)).alias("total_transactions"),
        _rows_where(df, fraud).alias("predicted_fraud"),
        _rows_where(df, F.col("risk_level") == high).alias("high_risk_transactions"),
        _rows_where(df, F.col("risk_level") == medium).alias("medium_risk_transactions"),
        *[F.sum(part).alias(f"all_{name}") for name, part in parts.items()],
        *[F.sum(F.when(fraud, part)).alias(f"fraud_{name}") for name, part in parts.items()],
        F.sum(F.when(fraud, _priced(df)).otherwise(0)).alias("fraud_amounts"),
    ]


def kpis_of_sums(sums: DataFrame) -> DataFrame:
    """The headline figures from one row of ``kpi_sums``."""
    zero = F.lit(0.0)
    total, frauds = (
        amount_from_parts(*[F.col(f"{kind}_{name}") for name in AMOUNT_PARTS]) for kind in ("all", "fraud")
    )
    return sums.select(
        "total_transactions",
        "predicted_fraud",
        rate_pct(F.col("predicted_fraud"), F.col("total_transactions")).alias("fraud_rate_%"),
        "high_risk_transactions",
        "medium_risk_transactions",
        F.coalesce(total, zero).alias("total_amount"),
        F.coalesce(frauds, zero).alias("fraud_amount"),
        F.coalesce(F.when(F.col("fraud_amounts") > 0, frauds / F.col("fraud_amounts")), zero).alias(
            "avg_fraud_amount"
        ),
    )


def summary_kpis(df: DataFrame) -> DataFrame:
    """Headline figures, one row."""
    return kpis_of_sums(df.agg(*kpi_sums(df)))


def _per_label(
    df: DataFrame,
    column: str,
    labels: tuple,
    measures: Callable[[Column], dict[str, Column]],
) -> DataFrame:
    """One row per label, in the order of the labels.

    The labels are known, so this is one aggregate without a group key: nothing to shuffle
    but one row per task, and the order needs no sort.
    """
    values = {label: measures(F.col(column) == label) for label in labels}
    flat = {
        f"{name}_{i}": value
        for i, label in enumerate(labels)
        for name, value in values[label].items()
    }
    one_row = df.agg(*[value.alias(name) for name, value in flat.items()])
    rows = [
        F.struct(
            F.lit(label).alias(column),
            *[F.col(f"{name}_{i}").alias(name) for name in values[label]],
        )
        for i, label in enumerate(labels)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def _rows_where(df: DataFrame, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, rows_in(df)).otherwise(0)), F.lit(0))


def risk_level_summary(df: DataFrame) -> DataFrame:
    """Count, total and mean amount per risk level; levels that do not occur are left out."""
    sums = _per_label(
        df,
        "risk_level",
        RISK_LEVELS,
        lambda level: {
            "transactions": _rows_where(df, level),
            "sum_amount": _total(df, level),
            "n_amounts": F.sum(F.when(level, _priced(df)).otherwise(0)),
        },
    )
    return sums.filter(F.col("transactions") > 0).select(
        "risk_level",
        "transactions",
        F.coalesce("sum_amount", F.lit(0.0)).alias("total_amount"),
        F.when(F.col("n_amounts") > 0, F.col("sum_amount") / F.col("n_amounts")).alias(
            "avg_amount"
        ),
    )


def amount_buckets(df: DataFrame) -> DataFrame:
    """Count and predicted frauds per amount band; bands that do not occur are left out."""
    fraud = F.col("prediction") == 1
    sums = _per_label(
        df.withColumn("amount_bucket", _bucket(df)),
        "amount_bucket",
        AMOUNT_BUCKETS,
        lambda band: {
            "transactions": _rows_where(df, band),
            "fraud": _rows_where(df, band & fraud),
        },
    )
    return sums.filter(F.col("transactions") > 0).withColumn(
        "fraud_rate_%", rate_pct(F.col("fraud"), F.col("transactions"))
    )


def predicted_class_counts(df: DataFrame) -> DataFrame:
    counts = _per_label(
        df, "prediction", (0.0, 1.0), lambda value: {"count": _rows_where(df, value)}
    )
    return counts.filter(F.col("count") > 0)


def risk_level_counts(df: DataFrame, missing: int | None = 0) -> DataFrame:
    """Count per level over all three levels in order; absent ones show ``missing``."""
    counts = _per_label(
        df, "risk_level", RISK_LEVELS, lambda level: {"transactions": _rows_where(df, level)}
    )
    if missing == 0:
        return counts
    absent = F.lit(missing).cast("bigint")
    return counts.withColumn(
        "transactions",
        F.when(F.col("transactions") > 0, F.col("transactions")).otherwise(absent),
    )


def sample_kpis(sample: DataFrame) -> DataFrame:
    """Figures of the analytics page, over all rows it is given: rates of a class-preserving
    sample would be biased by how it was drawn."""
    return summary_kpis(sample).select(
        F.col("total_transactions").alias("transactions"),
        "predicted_fraud",
        "fraud_rate_%",
        "high_risk_transactions",
    )


def top_risk(df: DataFrame, n: int = TOP_RISK_ROWS, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The n riskiest rows. NULL and NaN scores sort last; name a key to settle ties.

    Each task sends on its own n best rows. These meet in groups of tasks first, then in one
    place, so no step takes more than n rows from each of ``TOP_GROUPS`` sources.
    """
    score = F.nanvl(F.col("risk_score"), F.lit(None).cast("double"))
    order = [score.desc_nulls_last(), *tiebreak]
    group = F.pmod(F.spark_partition_id(), F.lit(TOP_GROUPS))
    best = Window.partitionBy("__group").orderBy(*order)
    first = (
        df.withColumn("__group", group)
        .withColumn("__place", F.row_number().over(best))
        .filter(F.col("__place") <= n)
        .drop("__group", "__place")
    )
    return first.orderBy(*order).limit(n)
