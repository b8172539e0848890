from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from payrisk import operators as ops
from payrisk.operators.histograms import Bins, histograms


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def counts_of(df):
    return [r["count"] for r in df.collect()]


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.one_of(st.floats(-1e6, 1e6), st.integers(-20, 20).map(lambda i: i / 10)),
        min_size=1,
        max_size=200,
    ),
    st.integers(1, 40),
)
def test_bins_match_numpy(spark, values, bins):
    result = ops.histogram(frame(spark, values), "x", bins).collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [r["count"] for r in result] == counts.tolist()
    centers = (edges[:-1] + edges[1:]) / 2
    assert [r["center"] for r in result] == pytest.approx(centers.tolist())


def test_values_on_edges_match_numpy(spark):
    values = [i / 100 for i in range(101)] * 3
    for bins in (7, 10, 30, 40):
        result = ops.histogram(frame(spark, values), "x", bins)
        assert counts_of(result) == np.histogram(values, bins=bins)[0].tolist()


def test_one_value_widens_the_range(spark):
    result = ops.histogram(frame(spark, [3.0] * 5), "x", 4).collect()
    assert [r["count"] for r in result] == np.histogram([3.0] * 5, bins=4)[0].tolist()
    assert result[0]["center"] == 2.625


def test_empty_input_counts_nothing(spark):
    assert counts_of(ops.histogram(frame(spark, []), "x", 5)) == [0] * 5


def test_values_without_a_place_are_left_out(spark):
    values = [1.0, 2.0, None, math.nan, math.inf, -math.inf]
    assert sum(counts_of(ops.histogram(frame(spark, values), "x", 5))) == 2


def test_several_histograms_at_once(scored_small):
    specs = {"a": Bins(F.col("risk_score"), 40), "b": Bins(F.col("amount"), 12)}
    both = histograms(scored_small, specs).orderBy("histogram", "bin").collect()
    amounts = [r["amount"] for r in scored_small.select("amount").collect()]
    assert [r["count"] for r in both if r["histogram"] == "b"] == (
        np.histogram(amounts, bins=12)[0].tolist()
    )
    assert sum(r["count"] for r in both if r["histogram"] == "a") == len(amounts)


def test_tail_above_the_fixed_probability(spark, scored_small):
    p = np.array([r[0] for r in scored_small.select("fraud_probability").collect()])
    assert counts_of(ops.tail_histogram(scored_small)) == (
        np.histogram(p[p > 0.3], bins=30)[0].tolist()
    )


def test_tail_falls_back_to_the_mean(spark):
    p = [0.0, 0.1, 0.2, 0.3]
    df = spark.createDataFrame([(v,) for v in p], "fraud_probability double")
    assert counts_of(ops.tail_histogram(df, 2)) == np.histogram([0.2, 0.3], bins=2)[0].tolist()


def test_log_bins_match_numpy(scored_small):
    result = ops.amount_log_histogram(scored_small).collect()
    rows = scored_small.select("amount", "prediction").collect()
    edges = np.logspace(0, np.log10(max(max(r["amount"] for r in rows), 10)), 60)
    edges[-1] *= 1 + 1e-12  # the largest amount belongs to the last bin
    for prediction in (0.0, 1.0):
        amounts = [max(r["amount"], 1) for r in rows if r["prediction"] == prediction]
        counts = [r["count"] for r in result if r["prediction"] == prediction]
        assert counts == np.histogram(amounts, bins=edges)[0].tolist()
    lower = [r["lower"] for r in result if r["prediction"] == 0.0]
    assert lower == pytest.approx(edges[:-1].tolist())


def test_log_bins_take_small_amounts_as_one(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (0.5, 0.0), (-3.0, 0.0), (5.0, 1.0), (None, 1.0)],
        "amount double, prediction double",
    )
    result = ops.amount_log_histogram(df, 10).collect()
    assert [r["count"] for r in result if r["prediction"] == 0.0] == [3] + [0] * 9
    assert sum(r["count"] for r in result if r["prediction"] == 1.0) == 1


def test_all_distributions_agree_with_the_single_ones(scored_small):
    everything = ops.distributions(scored_small).orderBy("bin").collect()

    def part(name):
        return [r["count"] for r in everything if r["histogram"] == name]

    assert part("fraud_probability") == counts_of(ops.probability_histogram(scored_small))
    assert part("fraud_probability_tail") == counts_of(ops.tail_histogram(scored_small))
    assert part("risk_score") == counts_of(ops.risk_score_histogram(scored_small))
    log_bins = ops.amount_log_histogram(scored_small).collect()
    for name, c in (("log10_amount_not_fraud", 0.0), ("log10_amount_fraud", 1.0)):
        assert part(name) == [r["count"] for r in log_bins if r["prediction"] == c]
