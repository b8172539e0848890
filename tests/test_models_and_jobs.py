from __future__ import annotations

import glob
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from payrisk import operators as ops
from payrisk.functions import add_features, with_risk
from payrisk.operators import models
from payrisk.plans import build_marts, run_export, run_training, write_marts
from payrisk.schema import LABEL_COUNT_SCHEMA, RISK_SCHEMA
from payrisk.sources import read_csv_parts, read_processed, read_scored, transactions

LIGHT = {"lr": {"maxIter": 20}, "rf": {"numTrees": 5}, "gbt": {"maxIter": 3}}


@pytest.fixture(scope="module")
def trained(tx_small):
    train, test = ops.split_by_key(add_features(tx_small), "tx_id")
    return ops.train_all(train, num_partitions=4, params=LIGHT), test.cache()


def test_default_parameters_are_the_published_ones(spark):
    gbt, forest = models._estimator("gbt", {}), models._estimator("rf", {})
    logistic = models._estimator("lr", {})
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize()) == (20, 5, 0.1)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getImpurity()) == (50, 5, "gini")
    assert (logistic.getMaxIter(), logistic.getRegParam()) == (100, 0.0)
    with pytest.raises(ValueError):
        models._estimator("svm", {})


def test_scores_are_consistent(trained):
    fitted, test = trained
    for model in fitted.values():
        scored = ops.score(model, test)
        assert scored.count() == test.count()
        wrong = scored.filter(
            ~F.col("fraud_probability").between(0, 1)
            | (F.col("risk_score") != F.col("fraud_probability") * 100)
            | ((F.col("fraud_probability") > 0.5) != (F.col("prediction") == 1))
        )
        assert wrong.isEmpty()


def test_models_learn_and_compare(trained):
    fitted, test = trained
    table = {r["model"]: r["auc"] for r in ops.model_comparison(fitted, test).collect()}
    assert set(table) == set(models.MODEL_TITLES.values())
    assert table["Gradient Boosted Trees"] > 0.85
    assert min(table.values()) > 0.75


def test_auc_is_the_rank_statistic(scored_small):
    rows = scored_small.select("isFraud", "fraud_probability").collect()
    pos = [r[1] for r in rows if r[0] == 1]
    neg = [r[1] for r in rows if r[0] == 0]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert ops.auc(scored_small) == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-9)


def test_save_and_load(spark, trained, tmp_path):
    fitted, test = trained
    paths = ops.save_models(fitted, str(tmp_path))
    paths = ops.save_models(fitted, str(tmp_path))  # replaces
    assert set(p.rsplit("/", 1)[1] for p in paths.values()) == {
        "logistic_model", "random_forest_model", "gbt_model",
    }
    loaded = ops.load_model(spark, paths["gbt"])
    first, second = (ops.score(m, test).select("tx_id", "risk_score") for m in
                     (fitted["gbt"], loaded))
    assert first.exceptAll(second).isEmpty()


def test_adhoc_scoring_computes_the_features(trained, make_tx):
    one = make_tx({"amount": 150_000.0, "oldbalanceOrg": 200_000.0, "newbalanceOrig": 50_000.0,
                   "newbalanceDest": 150_000.0})
    row = ops.score_transactions(one, trained[0]["gbt"]).first()
    assert (row["balanceError"], row["destBalanceError"]) == (0.0, 0.0)
    assert (row["highValueTransaction"], row["accountDrained"]) == (0, 0)
    assert row["risk_level"] in ("Low Risk", "Medium Risk", "High Risk")


def test_missing_inputs_fail_a_batch(trained, make_tx):
    with pytest.raises(Exception, match="null|NULL"):
        ops.score_transactions(make_tx({"amount": None}), trained[0]["lr"]).collect()


def test_training_job(spark, tx_small, tmp_path):
    out = str(tmp_path)
    table = run_training(tx_small, out, "tx_id", num_partitions=4, params=LIGHT)
    assert table.count() == 3
    featured = read_processed(spark, f"{out}/processed_transactions")
    assert featured.count() == tx_small.count()
    labels = read_csv_parts(spark, f"{out}/fraud_by_type", LABEL_COUNT_SCHEMA)
    assert labels.agg(F.sum("count")).first()[0] == tx_small.count()
    risk = read_csv_parts(spark, f"{out}/final_risk_scores", RISK_SCHEMA)
    assert risk.count() == ops.split_by_key(tx_small, "tx_id")[1].count()
    assert ops.load_model(spark, f"{out}/models/gbt_model").stages
    for name in ("fraud_vs_normal", "high_value_fraud", "account_drained_cases"):
        assert glob.glob(f"{out}/{name}/part-*.csv")


def test_export_then_marts(spark, tx_small, trained, tmp_path):
    out = str(tmp_path)
    path = run_export(tx_small, trained[0]["gbt"], out, "loose", ("tx_id",))
    scored = read_scored(spark, path, ("tx_id",))
    assert scored.count() == tx_small.count()
    assert scored.filter(F.col("fraud_probability").isNull()).isEmpty()

    labels = ops.fraud_by_type_long(tx_small)
    tables = build_marts(scored, labels, limit=3000, key="tx_id")
    written = write_marts(tables, out)
    assert set(written) == {
        "transactions_scored", "summary_kpis", "fraud_by_type", "risk_level_summary",
        "amount_buckets",
    }
    for name in set(written) - {"transactions_scored"}:
        assert Path(f"{out}/{name}.csv").is_file()
    frauds = scored.filter("prediction = 1").count()
    fact = tables["transactions_scored"]
    assert fact.count() == max(3000, frauds)
    assert fact.filter("prediction = 1").count() == frauds
    assert build_marts(scored)["transactions_scored"].count() == scored.count()
    kpis = tables["summary_kpis"].first()
    assert kpis["total_transactions"] == tx_small.count()
    assert kpis["predicted_fraud"] == frauds
    direct = ops.summary_kpis(with_risk(scored)).first()
    assert kpis == direct


def test_session_and_view(spark):
    view = transactions(spark, "/root/testdata/sf0.001")
    assert view.count() == view.select("tx_id").distinct().count() == 6000
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_command_line_end_to_end(spark, tx_small, tmp_path, capsys):
    from payrisk.__main__ import main
    from payrisk.sources import write_csv

    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    write_csv(tx_small.drop("tx_id"), data)
    main(["train", data, out])
    assert "Gradient Boosted Trees" in capsys.readouterr().out
    model = f"{out}/models/gbt_model"
    main(["export", data, model, out])
    predictions = f"{out}/fraud_predictions"
    main(["marts", predictions, f"{out}/fraud_by_type", f"{out}/bi"])
    kpis = spark.read.option("header", True).csv(f"{out}/bi/summary_kpis.csv").first()
    assert int(kpis["total_transactions"]) == tx_small.count()
    fact = spark.read.option("header", True).csv(f"{out}/bi/transactions_scored")
    assert fact.count() == tx_small.count()
    for job in (["marts", f"{out}/none", f"{out}/fraud_by_type", f"{out}/no"], ["distributions", f"{out}/none", f"{out}/no"]):
        with pytest.raises(AnalysisException):
            main(job)
    main(["distributions", predictions, f"{out}/bi/distributions"])
    bins = spark.read.option("header", True).csv(f"{out}/bi/distributions")
    assert bins.count() == 40 + 30 + 40 + 59 + 59
    main(["score", data, model, f"{out}/scores", "--rows", "3"])
    assert spark.read.option("header", True).csv(f"{out}/scores").count() == tx_small.count()
    assert "risk_level" in capsys.readouterr().out
