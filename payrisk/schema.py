"""Column lists, schemas and fixed domains shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed by the data format. One row per payment; passing this schema saves the inference scan over the input.
TX_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)

# Fixed by the data format: scored transactions as exported for BI.
SCORED_SCHEMA = T.StructType(
    [
        T.StructField("amount", T.DoubleType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("fraud_probability", T.DoubleType()),
    ]
)

RISK_SCHEMA = T.StructType(
    [
        T.StructField("prediction", T.DoubleType()),
        T.StructField("fraud_probability", T.DoubleType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("risk_level", T.StringType()),
    ]
)

LABEL_COUNT_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("count", T.LongType()),
    ]
)

# Model inputs, in vector order.
FEATURES = (
    "amount",
    "oldbalanceOrg",
    "newbalanceOrig",
    "oldbalanceDest",
    "newbalanceDest",
    "balanceError",
    "destBalanceError",
    "highValueTransaction",
    "accountDrained",
)

# Published thresholds, labels and rule weights.
HIGH_VALUE_AMOUNT = 200_000
RISK_LEVELS = ("Low Risk", "Medium Risk", "High Risk")
RISK_CUTS = (40, 70)  # upper ends (inclusive) of Low and Medium
AMOUNT_BUCKET_STARTS = (0, 1_000, 10_000, 100_000, 200_000, 500_000)
AMOUNT_BUCKETS = ("<1K", "1K–10K", "10K–100K", "100K–200K", "200K–500K", "500K+")
# Hundredths of the published weights, as integers so that sums are exact.
RULE_POINTS = {
    "high_value_flag": 35,
    "drained_flag": 30,
    "large_amount": 15,
    "balance_error": 10,
    "dest_balance_error": 10,
}
RULE_POINTS_CAP = 99
BALANCE_ERROR_LIMIT = 1_000
TAIL_PROBABILITY = 0.3
TRAIN_FRACTION = 0.8
SPLIT_SEED = 42
TOP_RISK_ROWS = 50
