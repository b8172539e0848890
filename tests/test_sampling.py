from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from payrisk import operators as ops
from payrisk.operators import sampling


def word(key: str) -> int:
    return int(hashlib.md5(key.encode()).hexdigest()[:8], 16)


def sample_word(key: str) -> int:
    return word("sample:" + key)


@pytest.fixture(scope="module")
def table(spark):
    rows = [(f"k{i}", float(i % 10 == 0), i) for i in range(2000)]
    return spark.createDataFrame(rows, "k string, prediction double, n int")


def test_split_by_key_is_the_hash_rule(table):
    train, test = ops.split_by_key(table, "k")
    keys = {r["k"] for r in train.collect()}
    assert keys == {f"k{i}" for i in range(2000) if word(f"k{i}") < 0.8 * 2**32}
    assert train.count() + test.count() == 2000
    assert train.columns == table.columns


def test_split_ignores_partitioning(table):
    def keys(df):
        return {r["k"] for r in ops.split_by_key(df)[0].collect()}

    assert keys(table.repartition(7)) == keys(table.coalesce(1))


def test_split_random_covers_all_rows(table):
    train, test = ops.split_random(table)
    assert train.count() + test.count() == 2000
    assert 1450 < train.count() < 1750


def test_samples_are_not_tied_to_the_split(table):
    sample = ops.downsample_exact(table, 500, "k").filter("prediction = 0")
    train, _ = ops.split_by_key(sample, "k")
    assert 0.65 < train.count() / sample.count() < 0.95


def test_head(table):
    assert ops.head_transactions(table, 17).count() == 17
    assert ops.head_transactions(table.repartition(50), 1999).count() == 1999


@pytest.mark.parametrize("exact", [False, True])
def test_whole_and_no_sample(table, exact):
    def sample(fraction):
        if exact:
            return ops.downsample_exact(table, key="k", fraction=fraction)
        return ops.downsample_keep_fraud(table, fraction, "k")

    assert sample(1.0).count() == 2000
    only_frauds = sample(0.0)
    assert only_frauds.count() == only_frauds.filter("prediction = 1").count() == 200


def test_more_frauds_than_the_limit(table):
    assert ops.downsample_exact(table, 150, "k").count() == 200
    assert ops.downsample_exact(table, 5000, "k").count() == 2000


def test_hash_sample_is_the_hash_rule(table):
    kept = {r["k"] for r in ops.downsample_keep_fraud(table, 0.4, "k").collect()}
    assert kept == {
        f"k{i}" for i in range(2000) if i % 10 == 0 or sample_word(f"k{i}") < 0.4 * 2**32
    }


def test_exact_sample_against_brute_force(table):
    others = sorted((f"k{i}" for i in range(2000) if i % 10), key=lambda k: (sample_word(k), k))
    frauds = {f"k{i}" for i in range(0, 2000, 10)}
    for limit in (201, 777, 1999):
        kept = [r["k"] for r in ops.downsample_exact(table, limit, "k").collect()]
        assert len(kept) == limit
        assert set(kept) == frauds | set(others[: limit - 200])
    kept = {r["k"] for r in ops.downsample_exact(table, key="k", fraction=0.3).collect()}
    assert kept == frauds | set(others[:540])


def test_exact_sample_cuts_inside_a_hot_key(spark):
    """A third of the rows share a key, another third are copies of one row."""
    rows = [("hot", 0.0, i) for i in range(1000)] + [("copy", 0.0, 0)] * 1000
    rows += [(f"k{i}", 0.0, i) for i in range(1000)] + [("f", 1.0, 0)] * 5
    df = spark.createDataFrame(rows, "k string, prediction double, n int").repartition(6)
    before = set()
    for limit in (50, 500, 1500, 2500, 3000):
        sample = ops.downsample_exact(df, limit, "k")
        assert sample.count() == limit
        assert sample.filter("prediction = 1").count() == 5
        assert sample.filter("k <> 'copy' and k <> 'f'").groupBy("k", "n").count().filter(
            F.col("count") > 1
        ).isEmpty()
        kept = {tuple(r) for r in sample.collect()}
        assert before <= kept  # one order at every size
        before = kept


def test_samples_without_a_key(table):
    assert ops.downsample_exact(table, 900).count() == 900
    around = ops.downsample_keep_fraud(table, 0.5).count()
    assert 1000 < around < 1200


def test_unknown_predictions_are_in_no_sample(spark):
    rows = [("a", None), ("b", 0.0), ("c", 1.0)]
    df = spark.createDataFrame(rows, "k string, prediction double")
    for sample in (
        ops.downsample_keep_fraud(df, 1.0, "k"), ops.downsample_exact(df, 3, "k"),
        ops.downsample_exact(df, 2, "k"), ops.downsample_exact(df, key="k", fraction=1.0),
    ):
        assert {r["k"] for r in sample.collect()} == {"b", "c"}


def test_bracket_and_slices_take_the_same_rows(spark, table, monkeypatch):
    by_bracket = {limit: set(ops.downsample_exact(table, limit, "k").collect()) for limit in (201, 900, 1999)}
    monkeypatch.setattr(sampling, "_from_bracket", lambda *_: None)
    for limit, rows in by_bracket.items():
        assert set(ops.downsample_exact(table, limit, "k").collect()) == rows


@pytest.mark.parametrize("shift", [-0.4, 0.4])
def test_sketch_that_misses_falls_back_to_slices(table, monkeypatch, shift):
    right = set(ops.downsample_exact(table, 900, "k").collect())
    real, tried = sampling._from_bracket, []

    class Misleading(int):
        def __truediv__(self, other):
            return int(self) / other + shift

    def missing(df, sketch, order, need, others):
        tried.append(real(df, sketch, order, Misleading(need), others))
        return tried[-1]

    monkeypatch.setattr(sampling, "_from_bracket", missing)
    assert set(ops.downsample_exact(table, 900, "k").collect()) == right
    assert tried == [None]


def test_two_passes_find_the_cut(spark, table):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = table.mapInArrow(counted, table.schema)
    sample = ops.downsample_exact(watched, 900, "k")
    assert seen.value == 2 * 2000
    assert sample.count() == 900 and seen.value == 3 * 2000
