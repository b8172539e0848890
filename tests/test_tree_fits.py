"""Trees fitted on counted bins against MLlib's own fits of the same rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from payrisk import operators as ops
from payrisk.operators import models, tree_columns, tree_fits
from payrisk.plans import catalog
from payrisk.schema import FEATURES


def labelled(spark, count: int, seed: int, digits: int = 2):
    r = random.Random(seed)
    data = []
    for _ in range(count):
        values = [round(r.uniform(0, 100), digits) for _ in FEATURES]
        values[3], values[7], values[8] = 5.0, float(values[0] > 50), float(r.random() < 0.2)
        score = values[0] + values[1] * values[8] - values[2] / 2 + r.gauss(0, 15)
        data.append((*values, int(score > 55)))
    schema = ", ".join(f"{c} double" for c in FEATURES) + ", isFraud int"
    return spark.createDataFrame(data, schema).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(spark):
    return labelled(spark, 3000, 5)


@pytest.fixture
def no_mllib_fit(monkeypatch):
    """MLlib's own tree fits, which keep an object for every row, must not be called."""
    def fail(*_):
        raise AssertionError("MLlib's own fit")

    for kind in (GBTClassifier, RandomForestClassifier):
        monkeypatch.setattr(kind, "_fit", fail)


def test_boosted_trees_are_those_of_mllib(rows):
    own = ops.train(rows, "gbt", maxIter=6).stages[-1]
    vectors = models.assembler().transform(rows)
    want = models._estimator("gbt", {"maxIter": 6}).fit(vectors)
    assert own.treeWeights == want.treeWeights and own.numFeatures == want.numFeatures
    scores = [
        m.transform(vectors).select(models.vector_to_array("rawPrediction")[1].alias("s")).toPandas()["s"]
        for m in (own, want)
    ]
    assert np.abs(scores[0] - scores[1]).max() < 1e-9
    assert {p.name: v for p, v in own.extractParamMap().items()} == {
        p.name: v for p, v in want.extractParamMap().items()
    }


def test_split_points_are_those_of_mllib(rows):
    found = tree_fits.candidate_splits(
        rows.select(*FEATURES, F.col("isFraud").cast("double").alias("isFraud")), FEATURES, "isFraud", 32
    )
    assert [len(s) for s in found] == [31, 31, 31, 0, 31, 31, 31, 1, 1]
    assert found[7].tolist() == [0.5]
    used = set()
    tree = models._estimator("rf", {"numTrees": 40}).fit(models.assembler().transform(rows))
    for _, nodes in tree_columns.stored_trees(tree):
        used |= {(n.split.featureIndex, n.split.leftCategoriesOrThreshold[0]) for n in nodes.values() if n.leftChild >= 0}
    assert used and all(value in found[feature] for feature, value in used)


def test_every_row_is_in_the_counts(spark):
    df = labelled(spark, 2000, 6, digits=-1)
    df = df.unionAll(df.limit(700)).cache()
    made = tree_fits.BinnedRows(df, FEATURES, "isFraud")
    bins, blocks = made.blocks(32)
    found = blocks.collect()
    made.release()
    assert sum(n.sum() for _, _, n in found) == 2700
    assert sum((n * label).sum() for _, label, n in found) == df.filter("isFraud = 1").count()
    counts = {}
    for places, label, n in found:
        for i in range(len(n)):
            key = (*places[:, i].tolist(), int(label[i]))
            assert key not in counts
            counts[key] = n[i]
    want = {}
    for row in df.collect():
        key = (*[int(np.searchsorted(s, row[f])) for s, f in zip(bins.splits, FEATURES)], row["isFraud"])
        want[key] = want.get(key, 0) + 1
    assert counts == want


def test_blocks_keep_all_keys_and_their_order(monkeypatch):
    monkeypatch.setattr(tree_fits, "BLOCK", 7)
    bins = tree_fits.Bins([np.arange(3.0), np.arange(1.0)])
    keys = np.arange(40)
    batches = [
        tree_fits.pa.RecordBatch.from_pydict({"key": keys[a:b], "n": keys[a:b] + 1})
        for a, b in ((0, 3), (3, 25), (25, 25), (25, 40))
    ]
    n = [np.frombuffer(x, np.float64) for out in tree_fits._packed(batches, bins) for x in out["n"].to_pylist()]
    assert [len(x) for x in n] == [7, 7, 7, 7, 7, 5]
    assert np.concatenate(n).tolist() == (keys + 1.0).tolist()


def test_forest_is_as_good_as_mllibs_and_the_same_each_time(rows):
    test = labelled(rows.sparkSession, 1500, 7)
    own, again = (ops.train(rows, "rf", numTrees=30) for _ in range(2))
    assert own.stages[-1].toDebugString.split("\n", 1)[1] == again.stages[-1].toDebugString.split("\n", 1)[1]
    want = models._estimator("rf", {"numTrees": 30}).fit(models.assembler().transform(rows))
    areas = [
        models.auc(m.transform(models.assembler().transform(test).drop(*drop)), score_col="rawPrediction")
        for m, drop in ((own, ("features",)), (want, ()))
    ]
    assert areas[0] == pytest.approx(areas[1], abs=0.01)
    forest = own.stages[-1]
    assert (forest.getNumTrees, forest.numClasses) == (30, 2)
    root = forest.trees[0]._java_obj.rootNode().impurityStats()
    assert root.count() != 3000 and abs(root.count() - 3000) < 5 * 3000**0.5  # drawn with replacement
    # rows that come four times weigh as much as four rows, and are drawn as often
    many = rows.unionAll(rows).unionAll(rows).unionAll(rows)
    drawn = [t._java_obj.rootNode().impurityStats().count() for t in ops.train(many, "rf", numTrees=30).stages[-1].trees]
    assert np.mean(drawn) == pytest.approx(12_000, rel=0.01)
    assert 60 < np.std(drawn) < 165  # of Poisson(12,000): 110; of 4 x Poisson(3,000): 219


def test_trees_fit_on_counted_bins_alone(rows, no_mllib_fit):
    fitted = ops.train_all(rows, params={"rf": {"numTrees": 3}, "gbt": {"maxIter": 2}})
    assert set(fitted) == set(models.MODEL_KINDS)
    assert not [r for r in rows.sparkSession.sparkContext._jsc.getPersistentRDDs().values() if "PythonRDD" in str(r)]


def test_what_the_bins_do_not_know_is_left_to_mllib(rows, no_mllib_fit):
    for frame, params in (
        (rows, {"maxDepth": 9}), (rows, {"subsamplingRate": 0.5}),
        (rows.withColumn("isFraud", F.lit(0)), {}), (rows.withColumn("amount", F.lit(None).cast("double")), {}),
        (rows.withColumn("amount", F.lit(float("nan"))), {}), (rows.limit(0), {}),
    ):
        with pytest.raises(AssertionError, match="own fit"):
            ops.train(frame, "rf", **params)


def test_missing_inputs_and_labels_fail_a_training(rows):
    for name in ("amount", "isFraud"):
        broken = rows.withColumn(name, F.when(F.col("amount") < 50, F.col(name)))
        with pytest.raises(Exception, match="(?i)null"):
            ops.train(broken, "gbt", maxIter=1)


def test_a_query_trains_the_models_it_asks_for(spark, monkeypatch):
    asked = []

    def train_all(df, kinds):
        asked.append(list(kinds))
        return {kind: f"model {kind}" for kind in kinds}

    monkeypatch.setattr(ops, "train_all", train_all)
    monkeypatch.setattr(catalog, "_models", {})
    monkeypatch.setattr(catalog, "split_part", lambda *_: None)
    folder = "/root/testdata/sf0.001"
    assert catalog.trained_models(spark, folder, ("gbt",)) == {"gbt": "model gbt"}
    assert list(catalog.trained_models(spark, folder)) == list(models.MODEL_KINDS)
    catalog.trained_models(spark, folder, ("rf",))
    assert asked == [["gbt"], ["lr", "rf"]]
