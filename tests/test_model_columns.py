"""Trees as columns, areas by ranks, running totals and bare models against plain answers."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from payrisk import operators as ops
from payrisk.operators import models, tree_columns
from payrisk.schema import FEATURES


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)
    data = []
    for i in range(1500):
        values = [round(r.uniform(0, 100), 2) for _ in FEATURES]
        data.append((*values, int(values[0] * values[1] > 2500 or r.random() < 0.03)))
    schema = ", ".join(f"{c} double" for c in FEATURES) + ", isFraud int"
    return spark.createDataFrame(data, schema).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return ops.train_all(rows, params={"rf": {"numTrees": 7}, "gbt": {"maxIter": 5}})


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_trees_as_columns_give_the_models_answers(rows, fitted, kind):
    scored = ops.score(fitted[kind], rows).withColumn("own", ops.tree_probability(fitted[kind]))
    assert scored.filter(F.abs(F.col("own") - F.col("fraud_probability")) > 1e-12).isEmpty()
    own = ops.score_by_columns(fitted[kind], rows.select(*FEATURES))
    assert own.filter("prediction = 1").count() == scored.filter("prediction = 1").count()
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan


def test_single_tree_and_models_without_trees(rows, fitted):
    tree = DecisionTreeClassifier(labelCol="isFraud", maxDepth=4).fit(models.assembler().transform(rows))
    scored = tree.transform(models.assembler().transform(rows))
    both = scored.select(
        tree_columns.tree_probability(tree).alias("own"), models.vector_to_array("probability")[1].alias("p")
    )
    assert both.filter(F.abs(F.col("own") - F.col("p")) > 1e-12).isEmpty()
    with pytest.raises(ValueError, match="no trees"):
        ops.tree_probability(fitted["lr"])


def test_categories_go_left_by_membership():
    class Split:
        featureIndex, numCategories, leftCategoriesOrThreshold = 1, 4, [0.0, 2.0]

    assert tree_columns._test(Split, ["a", "b"]) == "double(`b`) IN (double('0.0'), double('2.0'))"


def brute_auc(pairs):
    pos, neg = [s for y, s in pairs if y == 1], [s for y, s in pairs if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_areas_of_several_models_with_ties(spark):
    r = random.Random(1)
    data = {
        "ties": [(r.randrange(2), float(r.randrange(4))) for _ in range(400)],
        "fine": [(y := r.randrange(2), r.gauss(y, 1)) for _ in range(300)],
        "hot": [(int(i % 3 == 0), 0.5 if i % 2 else float(i)) for i in range(300)],
        "zeros": [(1, 0.0), (0, -0.0), (1, 2.0), (0, float("-inf"))],
    }
    rows = [(m, y, s) for m, pairs in data.items() for y, s in pairs]
    rows += [("ties", None, 1.0), ("ties", 1, None), ("one class", 1, 0.3)]
    df = spark.createDataFrame(rows, "model string, isFraud int, score double").repartition(7)
    got = {r["model"]: r for r in ops.rank_auc(df).collect()}
    for m, pairs in data.items():
        assert got[m]["auc"] == pytest.approx(brute_auc(pairs), abs=1e-15)
        assert got[m]["positives"] + got[m]["negatives"] == len(pairs)
    assert got["one class"]["auc"] is None
    assert ops.rank_auc(df.limit(0)).count() == 0


def test_area_equals_the_evaluator(rows, fitted):
    scored = ops.score(fitted["rf"], rows)
    long = scored.select(F.lit("rf").alias("model"), "isFraud", F.col("fraud_probability").alias("score"))
    assert ops.rank_auc(long).first()["auc"] == pytest.approx(ops.auc(scored), abs=1e-12)


def test_comparison_scans_once_for_all_models(rows, fitted, spark, tmp_path):
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    table = ops.model_comparison(fitted, stored)
    assert {r["model"] for r in table.collect()} == set(models.MODEL_TITLES.values())
    for kind, model in fitted.items():
        want = ops.auc(model.transform(stored), score_col="rawPrediction")
        own = table.filter(F.col("model") == models.MODEL_TITLES[kind]).first()["auc"]
        assert own == pytest.approx(want, abs=1e-12)


def test_running_totals_equal_a_window(spark):
    r = random.Random(2)
    data = [(r.choice("ab"), i, r.randrange(100), r.randrange(5)) for i in r.sample(range(10_000), 700)]
    df = spark.createDataFrame(data, "g string, k int, v long, w long").repartition(9)
    for by in ((), ("g",)):
        got = ops.running_totals(df, ["v", "w"], ["k"], by).collect()
        assert len(got) == len(data)
        for row in got:
            earlier = [x for x in data if x[1] < row["k"] and (not by or x[0] == row["g"])]
            assert (row["v_before"], row["w_before"]) == (sum(x[2] for x in earlier), sum(x[3] for x in earlier))
    assert ops.running_totals(df.limit(0), ["v"], ["k"]).count() == 0


@pytest.mark.parametrize("kind", ["lr", "rf", "gbt"])
def test_bare_models_load_with_their_inputs_put_before(spark, rows, fitted, tmp_path, kind):
    path = str(tmp_path / kind)
    fitted[kind].stages[-1].write().save(path)
    loaded = ops.load_model(spark, path)
    a, b = (ops.score(m, rows).select(*FEATURES, "fraud_probability") for m in (loaded, fitted[kind]))
    assert a.exceptAll(b).isEmpty() and a.count() == rows.count()


def test_bare_model_of_other_inputs_is_refused(spark, rows, tmp_path):
    narrow = models.assembler().setInputCols(["amount"]).transform(rows)
    DecisionTreeClassifier(labelCol="isFraud").fit(narrow).write().save(str(tmp_path / "m"))
    with pytest.raises(ValueError, match="takes 1 inputs"):
        ops.load_model(spark, str(tmp_path / "m"))
