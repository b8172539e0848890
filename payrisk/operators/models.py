"""Training, comparing, storing and applying the three classifiers with MLlib."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.functions.features import Drained, add_features
from payrisk.functions.risk import with_risk
from payrisk.operators.ranks import rank_auc
from payrisk.operators.tree_fits import BinnedRows, fit_trees
from payrisk.schema import FEATURES, SPLIT_SEED
from payrisk.session import shared_dir

LABEL = "isFraud"
MODEL_KINDS = ("lr", "rf", "gbt")
TREE_KINDS = ("rf", "gbt")
# Titles and folder names.
MODEL_TITLES = {
    "lr": "Logistic Regression",
    "rf": "Random Forest",
    "gbt": "Gradient Boosted Trees",
}
MODEL_FOLDERS = {"lr": "logistic_model", "rf": "random_forest_model", "gbt": "gbt_model"}

BARE_MODELS = {
    kind.__name__: kind
    for kind in (
        DecisionTreeClassificationModel,
        GBTClassificationModel,
        LogisticRegressionModel,
        RandomForestClassificationModel,
    )
}


def assembler(handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(
        inputCols=list(FEATURES), outputCol="features", handleInvalid=handle_invalid
    )


def _estimator(kind: str, params: Mapping):
    common = {"featuresCol": "features", "labelCol": LABEL}
    if kind == "lr":
        return LogisticRegression(**common, **params)
    if kind == "rf":
        return RandomForestClassifier(
            **common, **{"numTrees": 50, "seed": SPLIT_SEED, **params}
        )
    if kind == "gbt":
        return GBTClassifier(**common, **{"maxIter": 20, "seed": SPLIT_SEED, **params})
    raise ValueError(f"unknown model kind {kind!r}, expected one of {MODEL_KINDS}")


def train(df: DataFrame, kind: str = "gbt", **params) -> PipelineModel:
    """Fit assembler and classifier on featured, labelled rows, as one artefact."""
    rows = BinnedRows(df, FEATURES, LABEL)
    try:
        return _fit(df, kind, params, rows)
    finally:
        rows.release()


def _fit(df: DataFrame, kind: str, params: Mapping, rows: BinnedRows) -> PipelineModel:
    """Trees grow on the counted bins, which the kinds share; MLlib fits the others itself."""
    first, estimator = assembler(), _estimator(kind, params)
    fitted = fit_trees(estimator, rows) if kind in TREE_KINDS else None
    if fitted is not None:
        return PipelineModel(stages=[first, fitted])
    shared_dir(df.sparkSession)  # lets tree boosting cut its lineage as it goes
    model = Pipeline(stages=[first, estimator]).fit(df.select(*FEATURES, LABEL))
    _drop_summary(model.stages[-1])
    return model


def _drop_summary(fitted) -> None:
    """A fresh classifier's summary holds the training table and its session, and goes along to
    every task that scores; in a session that has observed a query it cannot even be sent."""
    if getattr(fitted, "hasSummary", False):
        fitted._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())


def train_all(
    df: DataFrame,
    kinds: Iterable[str] = MODEL_KINDS,
    num_partitions: int | None = None,
    params: Mapping[str, Mapping] | None = None,
) -> dict[str, PipelineModel]:
    """Fit several models on the same column-pruned training set.

    Give a stored table: the fits read it a few times and keep their own compact form.
    ``num_partitions`` is for small inputs, to use all cores: it shuffles the training set
    and persists it while the models are fitted.
    """
    narrow = df.select(*FEATURES, LABEL)
    if num_partitions:
        narrow = narrow.repartition(num_partitions).persist(StorageLevel.MEMORY_AND_DISK)
    rows = BinnedRows(narrow, FEATURES, LABEL)
    try:
        return {kind: _fit(narrow, kind, (params or {}).get(kind, {}), rows) for kind in kinds}
    finally:
        rows.release()
        if num_partitions:
            narrow.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Featured rows with prediction, fraud probability, risk score and risk level."""
    vectors = ("features", "rawPrediction", "probability")
    return with_risk(model.transform(df)).drop(*vectors)


def score_transactions(
    df: DataFrame, model: PipelineModel, drained: Drained = "strict"
) -> DataFrame:
    """Score raw transactions of any number; the features are always computed here."""
    return score(model, add_features(df, drained=drained))


def auc(scored: DataFrame, label: str = LABEL, score_col: str = "fraud_probability") -> float:
    """Area under the ROC curve, exact: every distinct score is a point of the curve."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score_col, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(scored.select(F.col(label).cast("double").alias(label), score_col))


def model_comparison(models: Mapping[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Columns ``model, auc``, one row per model, measured on held-out rows.

    All models score in one scan; their areas come from one pass over the distinct scores.
    """
    scored, scores = test.select(*FEATURES, LABEL), []
    for kind, model in models.items():
        own = f"__score_{kind}"
        scored = model.transform(scored).withColumn(own, vector_to_array("rawPrediction")[1])
        scored = scored.drop("features", "rawPrediction", "probability", "prediction")
        title = F.lit(MODEL_TITLES.get(kind, kind))
        scores.append(F.struct(title.alias("model"), F.col(own).alias("score")))
    return rank_auc(scored.select(LABEL, F.inline(F.array(*scores))), LABEL).select("model", "auc")


def save_models(models: Mapping[str, PipelineModel], folder: str) -> dict[str, str]:
    """Store each model under its usual folder name, replacing an earlier one."""
    paths = {kind: f"{folder}/{MODEL_FOLDERS.get(kind, kind)}" for kind in models}
    for kind, model in models.items():
        model.write().overwrite().save(paths[kind])
    return paths


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """A stored pipeline, or a bare classifier with the assembler of its inputs put before it.

    The class is read from the folder's metadata, so a bare model needs no name or flag. Its
    vector must be that of ``FEATURES``, in that order.
    """
    stored_class = json.loads(spark.read.text(f"{path}/metadata").first()[0])["class"]
    kind = BARE_MODELS.get(stored_class.rpartition(".")[2])
    if kind is None:
        return PipelineModel.read().session(spark).load(path)
    model = kind.read().session(spark).load(path)
    if model.numFeatures != len(FEATURES):
        raise ValueError(f"{path} takes {model.numFeatures} inputs, not {len(FEATURES)}")
    first = assembler().setOutputCol(model.getFeaturesCol())
    return PipelineModel(stages=[first, model])
