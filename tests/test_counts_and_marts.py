from __future__ import annotations

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from payrisk import operators as ops
from payrisk.functions import add_features, rule_score
from payrisk.schema import AMOUNT_BUCKETS, LABEL_COUNT_SCHEMA, RISK_LEVELS

SCORED = "amount double, prediction double, fraud_probability double, risk_score double, " \
    "risk_level string"


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def scored(spark):
    def make(*items):
        """(amount, probability) pairs as scored rows."""
        from payrisk.functions import with_risk

        base = spark.createDataFrame(
            [(a, float(p >= 0.5), p) for a, p in items],
            "amount double, prediction double, fraud_probability double",
        )
        return with_risk(base)

    return make


def test_label_counts_from_rows_and_from_cells(tx_small):
    featured = add_features(tx_small)
    cells = ops.label_cells(featured)
    for report in (
        ops.row_count, ops.fraud_vs_normal, ops.fraud_by_type_long, ops.high_value_fraud,
        ops.account_drained_cases, ops.fraud_by_type,
    ):
        assert sorted(rows(report(featured)), key=str) == sorted(rows(report(cells)), key=str)


def test_counts_of_flagged_rows_ignore_unknown_flags(make_tx):
    df = add_features(make_tx({"amount": None}, {"amount": 300_000.0, "isFraud": 1}, {}))
    assert rows(ops.high_value_fraud(df)) == [(1, 1)]


def test_types_side_by_side(make_tx):
    df = make_tx(
        {"type": "TRANSFER", "isFraud": 1}, {"type": "TRANSFER"}, {"type": "TRANSFER"},
        {"type": "PAYMENT"}, {"type": "WIRE", "isFraud": 1}, {"type": None}, {"isFraud": None},
    )
    assert rows(ops.fraud_by_type(df)) == [
        ("PAYMENT", 1, 0, 1, 0.0), ("TRANSFER", 2, 1, 3, 33.3333), ("WIRE", 0, 1, 1, 100.0),
    ]
    assert [r[0] for r in rows(ops.fraud_by_type(df, "total"))] == ["TRANSFER", "PAYMENT", "WIRE"]
    assert [r[0] for r in rows(ops.fraud_by_type(df, "rate"))] == ["WIRE", "TRANSFER", "PAYMENT"]


def test_published_rates_by_type(spark):
    """Published label counts and the rates published for them."""
    counts = [
        ("CASH_IN", 0, 1399284), ("CASH_OUT", 0, 2233384), ("CASH_OUT", 1, 4116),
        ("DEBIT", 0, 41432), ("PAYMENT", 0, 2151495), ("TRANSFER", 0, 528812),
        ("TRANSFER", 1, 4097),
    ]
    table = ops.fraud_by_type_from_counts(spark.createDataFrame(counts, LABEL_COUNT_SCHEMA))
    assert rows(table.select("type", "total", "`fraud_rate_%`")) == [
        ("CASH_IN", 1399284, 0.0), ("CASH_OUT", 2237500, 0.184), ("DEBIT", 41432, 0.0),
        ("PAYMENT", 2151495, 0.0), ("TRANSFER", 532909, 0.7688),
    ]


def _cell(prediction, level, bucket, n, amount):
    micros = int(Decimal(amount) * 1_000_000)
    units, rest = divmod(micros, 1_000_000)
    return (prediction, level, bucket, n, n, units >> 20, units & ((1 << 20) - 1), rest, None)


CELLS = (
    "prediction double, risk_level string, amount_bucket string, n_rows bigint, "
    "n_amounts bigint, units_high bigint, units_low bigint, micros bigint, huge double"
)


def test_published_kpis_and_levels(spark):
    """Published totals of 6.4 million scored rows, put in as cells."""
    low, medium, high = RISK_LEVELS
    cells = spark.createDataFrame(
        [
            _cell(0.0, low, None, 6354438, "1132348267787.38"),
            _cell(1.0, medium, None, 1, "799149.76"),
            _cell(1.0, high, None, 8181, "12043877822.63"),
        ],
        CELLS,
    )
    assert rows(ops.summary_kpis(cells)) == [
        (6362620, 8182, 0.1286, 8181, 1, 1144392944759.77, 12044676972.39, 1472094.4723038375)
    ]
    assert rows(ops.risk_level_summary(cells)) == [
        (low, 6354438, 1132348267787.38, 178198.01968126526),
        (medium, 1, 799149.76, 799149.76),
        (high, 8181, 12043877822.63, 1472176.7293277103),
    ]


def test_published_bucket_rates(spark):
    published = [
        (142642, 58, 0.0407), (1143361, 220, 0.0192), (2239253, 1422, 0.0635),
        (1163794, 1029, 0.0884), (1333286, 1595, 0.1196), (340284, 3858, 1.1338),
    ]
    cells = []
    for name, (n, fraud, _) in zip(AMOUNT_BUCKETS, published):
        cells += [_cell(1.0, None, name, fraud, "0"), _cell(0.0, None, name, n - fraud, "0")]
    table = ops.amount_buckets(spark.createDataFrame(cells, CELLS))
    assert rows(table) == [(b, *p) for b, p in zip(AMOUNT_BUCKETS, published)]


def test_marts_from_rows_and_from_cells(scored_small):
    cells = ops.scored_cells(scored_small)
    for mart in (
        ops.summary_kpis, ops.risk_level_summary, ops.amount_buckets,
        ops.predicted_class_counts, ops.risk_level_counts, ops.row_count,
    ):
        assert rows(mart(scored_small)) == rows(mart(cells))


def test_conservation(scored_small):
    kpis = ops.summary_kpis(scored_small).first()
    levels = ops.risk_level_summary(scored_small).collect()
    buckets = ops.amount_buckets(scored_small).collect()
    types = ops.fraud_by_type(scored_small).collect()
    total = kpis["total_transactions"]
    assert total == scored_small.count()
    assert sum(r["transactions"] for r in levels) == total
    assert sum(r["transactions"] for r in buckets) == total
    assert sum(r["total"] for r in types) == total
    assert sum(r["fraud"] for r in buckets) == kpis["predicted_fraud"]
    assert sum(r["total_amount"] for r in levels) == pytest.approx(kpis["total_amount"])


def test_sums_are_exact_and_ignore_missing_amounts(scored):
    df = scored((0.1, 0.9), (0.2, 0.9), (None, 0.9), (math.nan, 0.9), (-5.25, 0.1))
    kpis = ops.summary_kpis(df).first()
    assert (kpis["total_amount"], kpis["fraud_amount"]) == (-4.95, 0.3)
    assert kpis["avg_fraud_amount"] == 0.15
    assert kpis["predicted_fraud"] == 4


def test_amounts_too_large_for_one_sum_of_cents(spark, scored):
    df = scored(*[(9e16 / 1.5, 0.1)] * 4)
    assert ops.summary_kpis(df).first()["total_amount"] == 2.4e17


def test_amounts_neither_fail_nor_vanish(scored):
    df = scored((math.inf, 0.9), (1.0, 0.9), (1e17, 0.1), (0.004, 0.1), (None, 0.1), (math.nan, 0.1))
    for table in (df, ops.scored_cells(df)):
        kpis = ops.summary_kpis(table).first()
        assert (kpis["total_transactions"], kpis["total_amount"]) == (6, math.inf)
        levels = {r["risk_level"]: r for r in ops.risk_level_summary(table).collect()}
        assert levels["High Risk"]["total_amount"] == math.inf
        assert levels["Low Risk"]["total_amount"] == 1e17
    small = ops.summary_kpis(scored((0.004, 0.1), (0.004, 0.1), (-0.25, 0.1))).first()
    assert small["total_amount"] == pytest.approx(-0.242, abs=1e-12)


def test_no_frauds_at_all(scored):
    df = scored((10.0, 0.1), (20.0, 0.2))
    assert rows(ops.summary_kpis(df)) == [(2, 0, 0.0, 0, 0, 30.0, 0.0, 0.0)]
    assert rows(ops.predicted_class_counts(df)) == [(0.0, 2)]
    assert rows(ops.risk_level_summary(df)) == [("Low Risk", 2, 30.0, 15.0)]
    assert rows(ops.amount_buckets(df)) == [("<1K", 2, 0, 0.0)]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCORED)
    assert rows(ops.summary_kpis(df)) == [(0, 0, None, 0, 0, 0.0, 0.0, 0.0)]
    assert rows(ops.risk_level_summary(df)) == rows(ops.amount_buckets(df)) == []
    assert rows(ops.row_count(df)) == [(0,)]


def test_level_counts_cover_all_levels(scored):
    df = scored((1.0, 0.1), (1.0, 0.95))
    low, medium, high = RISK_LEVELS
    assert rows(ops.risk_level_counts(df)) == [(low, 1), (medium, 0), (high, 1)]
    assert rows(ops.risk_level_counts(df, None)) == [(low, 1), (medium, None), (high, 1)]


def test_top_risk_puts_unscored_rows_last(spark):
    df = spark.createDataFrame(
        [("a", 10.0), ("b", math.nan), ("c", 90.0), ("d", None), ("e", 90.0)],
        "k string, risk_score double",
    )
    assert [r["k"] for r in ops.top_risk(df, 3, ("k",)).collect()] == ["c", "e", "a"]


def test_top_risk_in_groups(spark, monkeypatch):
    monkeypatch.setattr(ops.marts, "TOP_GROUPS", 3)
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 97).cast("double").alias("risk_score"))
    got = [r["k"] for r in ops.top_risk(df.repartition(20), 15, ("k",)).collect()]
    assert got == sorted(range(1000), key=lambda k: (-(k % 97), k))[:15]


def test_sample_figures(scored_small):
    row, kpis = ops.sample_kpis(scored_small).first(), ops.summary_kpis(scored_small).first()
    assert row["transactions"] == kpis["total_transactions"] == scored_small.count()
    assert row["fraud_rate_%"] == kpis["fraud_rate_%"]


def test_rule_scores_on_rows_without_model(make_tx):
    df = rule_score(add_features(make_tx({}, {"amount": 300_000.0, "newbalanceOrig": 0.0})))
    assert ops.predicted_class_counts(df).agg(F.sum("count")).first()[0] == 2
