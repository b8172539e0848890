"""Tree ensembles as column expressions: a model's answers in plain Spark SQL.

A stored model keeps its trees as a table of nodes. Each tree becomes nested conditions over
the feature columns, in the order of its splits, so a row walks one path of it. The sum over
the trees is one expression inside code generation: no vector, no Python, and it can be put
into any query, filter or view.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from payrisk.schema import FEATURES
from payrisk.session import workspace

TREE_MODELS = (DecisionTreeClassificationModel, GBTClassificationModel, RandomForestClassificationModel)


def classifier_of(model: Transformer) -> Transformer:
    """The classifier itself, of a pipeline its last stage."""
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def stored_trees(model: Transformer) -> list[tuple[float, dict[int, Row]]]:
    """(weight, nodes by id) of every tree, read from what the model writes of itself.

    This is the model, not data: a few dozen nodes a tree whatever it was trained on.
    """
    fitted = classifier_of(model)
    if not isinstance(fitted, TREE_MODELS):
        raise ValueError(f"{type(fitted).__name__} has no trees")
    spark = SparkSession.active()
    with workspace(spark) as work:
        path = f"{work.folder('trees')}/model"
        fitted.write().save(path)
        nodes = spark.read.parquet(f"{path}/data")
        if isinstance(fitted, DecisionTreeClassificationModel):
            return [(1.0, {n.id: n for n in nodes.collect()})]
        trees: dict[int, dict[int, Row]] = {}
        for row in nodes.collect():
            trees.setdefault(row.treeID, {})[row.nodeData.id] = row.nodeData
        # Columns by place: tree, its metadata, its weight.
        weights = {row[0]: row[2] for row in spark.read.parquet(f"{path}/treesMetadata").collect()}
    return [(float(weights[i]), trees[i]) for i in sorted(trees)]


def _number(value: float) -> str:
    return f"double('{value!r}')"


def _test(split: Row, features: Sequence[str]) -> str:
    """The condition of a row's way to the left."""
    name = f"double(`{features[split.featureIndex]}`)"
    if split.numCategories < 0:
        return f"{name} <= {_number(split.leftCategoriesOrThreshold[0])}"
    return f"{name} IN ({', '.join(map(_number, split.leftCategoriesOrThreshold))})"


def _walk(nodes: dict[int, Row], at: int, features: Sequence[str], leaf) -> str:
    node = nodes[at]
    if node.leftChild < 0:
        return _number(leaf(node))
    left, right = (_walk(nodes, child, features, leaf) for child in (node.leftChild, node.rightChild))
    return left if left == right else f"IF({_test(node.split, features)}, {left}, {right})"


def _share(node: Row) -> float:
    total = sum(node.impurityStats)
    return node.impurityStats[1] / total if total else 0.0


def tree_probability(model: Transformer, features: Sequence[str] = FEATURES) -> Column:
    """Probability of class 1 as the two-class model gives it, from columns by the names of
    ``features`` in the order of its vector. A missing value takes the way to the right, as
    its comparison is not true."""
    trees = stored_trees(model)
    boosted = isinstance(classifier_of(model), GBTClassificationModel)
    total = F.lit(0.0)
    for weight, nodes in trees:
        leaf = (lambda node: node.prediction) if boosted else _share
        total = total + F.lit(weight) * F.expr(_walk(nodes, 0, features, leaf))
    if boosted:
        return 1 / (1 + F.exp(-2 * total))
    return total / F.lit(sum(weight for weight, _ in trees))


def score_by_columns(model: Transformer, df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with ``fraud_probability`` and ``prediction`` worked out by the model's trees alone."""
    scored = df.withColumn("fraud_probability", tree_probability(model, features))
    return scored.withColumn("prediction", (F.col("fraud_probability") > 0.5).cast("double"))
