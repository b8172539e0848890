from __future__ import annotations

import itertools
import math

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from payrisk.functions import (
    add_amount_bucket,
    add_features,
    add_risk_level,
    add_risk_score,
    project_export,
    project_risk,
    project_stream,
    rate_pct,
    rule_score,
    stable_hash32,
)
from payrisk.schema import AMOUNT_BUCKETS, RISK_LEVELS


def column(df, name):
    return [row[name] for row in df.collect()]


def test_balance_errors_follow_the_written_order(make_tx):
    df = add_features(make_tx({"amount": 0.3, "oldbalanceOrg": 0.1, "newbalanceOrig": 0.2,
                               "oldbalanceDest": 0.1, "newbalanceDest": 0.7}))
    row = df.first()
    assert row["balanceError"] == (0.1 - 0.2) - 0.3
    assert row["destBalanceError"] == (0.7 - 0.1) - 0.3


def test_high_value_is_strictly_above_the_limit(make_tx):
    amounts = [{"amount": a} for a in (0.0, 200_000.0, 200_000.01, None)]
    assert column(add_features(make_tx(*amounts)), "highValueTransaction") == [0, 0, 1, None]
    zeroed = add_features(make_tx(*amounts), null_as_zero=True)
    assert column(zeroed, "highValueTransaction") == [0, 0, 1, 0]


def test_drained_forms_differ_on_empty_senders(make_tx):
    rows = [
        {"oldbalanceOrg": 10.0, "newbalanceOrig": 0.0},
        {"oldbalanceOrg": 0.0, "newbalanceOrig": 0.0},
        {"oldbalanceOrg": 10.0, "newbalanceOrig": 5.0},
        {"oldbalanceOrg": None, "newbalanceOrig": 0.0},
        {"oldbalanceOrg": 10.0, "newbalanceOrig": None},
    ]
    assert column(add_features(make_tx(*rows)), "accountDrained") == [1, 0, 0, None, None]
    assert column(add_features(make_tx(*rows), "loose"), "accountDrained") == [1, 1, 0, 1, 0]
    with pytest.raises(ValueError):
        add_features(make_tx(*rows), "other")


def test_risk_level_bounds(spark):
    scores = [0.0, 40.0, 40.0001, 70.0, 70.0001, 100.0, math.nan, None]
    df = spark.createDataFrame([(s,) for s in scores], "risk_score double")
    low, medium, high = RISK_LEVELS
    assert column(add_risk_level(df), "risk_level") == [
        low, low, medium, medium, high, high, None, None,
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 100), min_size=1, max_size=50))
def test_risk_level_spellings_agree(spark, scores):
    df = spark.createDataFrame([(s,) for s in scores], "risk_score double")
    s = F.col("risk_score")
    other = F.when(s > 70, "High Risk").when(s > 40, "Medium Risk").otherwise("Low Risk")
    rows = add_risk_level(df).withColumn("other", other).collect()
    cut = pd.cut(pd.Series(scores), bins=[-0.01, 40, 70, 100.01], labels=list(RISK_LEVELS))
    assert [r["risk_level"] for r in rows] == [r["other"] for r in rows] == cut.tolist()


def test_probability_comes_from_the_vector(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(0.25, 0.75),)], ["probability"])
    row = add_risk_score(df).first()
    assert (row["fraud_probability"], row["risk_score"]) == (0.75, 75.0)


def test_amount_bands_are_left_closed(spark):
    amounts = [0.0, 999.99, 1000.0, 10_000.0, 100_000.0, 200_000.0, 200_000.01, 500_000.0,
               -1.0, math.nan, math.inf, None]
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    names = dict(enumerate(AMOUNT_BUCKETS))
    expected = [names.get(i) for i in (0, 0, 1, 2, 3, 4, 4, 5, None, None, None, None)]
    assert column(add_amount_bucket(df), "amount_bucket") == expected


def test_rule_score_on_every_combination(spark):
    """All 32 rule outcomes, against the weights summed as floats."""
    weights = (0.35, 0.30, 0.15, 0.10, 0.10)
    combinations = list(itertools.product((0, 1), repeat=5))
    rows = [
        (flag, drained, 200_001.0 if large else 200_000.0,
         -1000.5 if off else 1000.0, 1000.5 if dest_off else -1000.0)
        for flag, drained, large, off, dest_off in combinations
    ]
    df = spark.createDataFrame(
        rows,
        "highValueTransaction int, accountDrained int, amount double, balanceError double, "
        "destBalanceError double",
    )
    for fired, row in zip(combinations, rule_score(df).collect()):
        p = min(sum(w for w, on in zip(weights, fired) if on), 0.99)
        level = RISK_LEVELS[2] if p > 0.7 else RISK_LEVELS[1] if p > 0.4 else RISK_LEVELS[0]
        assert row["fraud_probability"] == pytest.approx(p, abs=1e-12)
        assert (row["prediction"], row["risk_level"]) == (float(p >= 0.5), level)


def test_rule_score_of_unknowns_is_zero(make_tx):
    unknown = make_tx({"amount": None, "oldbalanceOrg": None, "newbalanceOrig": None,
                       "oldbalanceDest": None, "newbalanceDest": None})
    row = rule_score(add_features(unknown)).first()
    assert (row["fraud_probability"], row["risk_level"]) == (0.0, "Low Risk")


def test_projections(make_tx):
    df = rule_score(add_features(make_tx({})))
    assert project_risk(df).columns == [
        "prediction", "fraud_probability", "risk_score", "risk_level",
    ]
    assert project_export(df, "type").columns[0] == "type"
    assert project_stream(df).columns[:3] == ["step", "type", "amount"]


def test_rates_round_half_even_and_stay_empty_without_rows(spark):
    df = spark.createDataFrame([(1, 3), (1, 32_000_000), (0, 0)], "part bigint, whole bigint")
    rates = column(df.select(rate_pct(F.col("part"), F.col("whole")).alias("r")), "r")
    assert rates == [33.3333, 0.0, None]


def test_stable_hash_is_the_leading_md5_word(spark):
    df = spark.createDataFrame([("abc",)], ["k"]).select(stable_hash32(F.col("k")).alias("h"))
    assert column(df, "h") == [2416005272]
