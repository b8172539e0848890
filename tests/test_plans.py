"""Shapes of physical plans that matter at scale, with all broadcasts switched off."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from payrisk import operators as ops
from payrisk.functions import add_features, rule_score
from payrisk.plans.catalog import QUERIES
from payrisk.sources import transactions

LAZY = [
    "rule_scores", "fraud_vs_normal", "fraud_by_type", "summary_kpis", "risk_level_summary",
    "amount_buckets", "risk_level_counts", "top_risk", "split_by_key", "event_round_trip",
]


@pytest.fixture(autouse=True)
def no_broadcasts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """A stored transaction table, as a user would have it."""
    path = str(tmp_path_factory.mktemp("plans") / "tx")
    transactions(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (\w+)", plan_of(df))


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python_workers(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for unwanted in ("NestedLoop", "CartesianProduct", "Python", "BroadcastExchange"):
        assert unwanted not in plan


def test_rows_are_scored_without_a_shuffle(table):
    assert exchanges(rule_score(add_features(table))) == []
    assert exchanges(ops.with_split(table, "tx_id")) == []


def test_marts_move_one_row_per_task(table):
    scored = rule_score(add_features(table))
    for mart in (ops.summary_kpis, ops.risk_level_summary, ops.amount_buckets,
                 ops.risk_level_counts, ops.predicted_class_counts):
        assert exchanges(mart(scored)) == ["SinglePartition"]
        assert "partial_sum" in plan_of(mart(scored))


def test_counts_combine_before_their_only_shuffle(table):
    for count in (ops.fraud_vs_normal, ops.fraud_by_type_long, ops.high_value_fraud):
        plan = plan_of(count(add_features(table)))
        assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan


def test_filters_and_columns_reach_the_scan(table):
    plan = plan_of(ops.high_value_fraud(add_features(table)))
    assert "GreaterThan(amount,200000.0)" in plan
    assert "ReadSchema: struct<amount:double,isFraud:int>" in plan
    plan = plan_of(ops.account_drained_cases(add_features(table)))
    assert "PushedFilters: [IsNotNull(oldbalanceOrg), IsNotNull(newbalanceOrig)" in plan


def test_top_rows_need_no_full_sort(table):
    """The rows of a task are cut to the best before they meet, in groups and then in one place."""
    plan = plan_of(ops.top_risk(rule_score(add_features(table)), tiebreak=("tx_id",)))
    assert "TakeOrderedAndProject" in plan and "WindowGroupLimit" in plan
    assert "Coalesce" not in plan and "rangepartitioning" not in plan


def test_the_head_squeezes_no_scan(table):
    assert "Coalesce" not in plan_of(ops.head_transactions(table, 10))


def test_samples_are_filters(table):
    sample = ops.downsample_keep_fraud(rule_score(add_features(table)), 0.1, "tx_id")
    assert exchanges(sample) == []


def test_histogram_ranges_are_computed_once(table):
    scored = rule_score(add_features(table)).select("fraud_probability")
    df = ops.probability_histogram(scored)
    df.collect()
    final = plan_of(df)
    assert "ReusedSubquery" in final
    assert "CartesianProduct" not in final and "NestedLoop" not in final


def test_order_lines_move_only_for_their_order_and_supplier(spark):
    df = transactions(spark, SMALL).agg(F.sum("newbalanceDest"), F.sum("newbalanceOrig"))
    plan = plan_of(df)
    assert plan.count("SortMergeJoin") == 3
    assert plan.count("hashpartitioning(o_custkey") == 1
    assert plan.count("hashpartitioning(l_orderkey") == 1
    assert plan.count("hashpartitioning(l_suppkey") == 1


def test_skewed_parties_are_split(spark):
    """A supplier on most order lines: adaptive execution splits its join partition."""
    from payrisk.sources import build_transactions

    lines = spark.range(200_000).select(
        F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50).cast("bigint")
        .alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(10.0).alias("l_extendedprice"),
        F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    orders = spark.range(200_000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 10).alias("o_custkey"),
        F.lit("5-LOW").alias("o_orderpriority"),
    )
    customer = spark.range(10).select(F.col("id").alias("c_custkey"), F.lit(1.0).alias("c_acctbal"))
    supplier = spark.range(50).select(F.col("id").alias("s_suppkey"), F.lit(1.0).alias("s_acctbal"))
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        df = build_transactions(lines, orders, customer, supplier).agg(
            F.count("*"), F.sum("newbalanceDest")
        )
        assert df.collect()[0][0] == 200_000
        assert "skew=true" in plan_of(df)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
