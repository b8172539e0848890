"""Forests and boosted trees fitted on counted bins: MLlib's algorithm and models, packed data.

A tree only ever asks a row for the bin that each of its features falls into. So the training
rows are binned once, equal binned rows of a label are counted, and the counts are kept in blocks
of a byte per feature. Every training row is in the counts. Where no two rows fall together, a
block still is a fraction of the objects MLlib keeps per row, and a level of a tree is a few array
operations over it. Splits, gains, stopping and pruning are those of MLlib, and so is the model
that comes out; boosted trees are MLlib's own trees but for the order in which sums are taken. In
a forest each row is drawn by Poisson(1) per tree, so n equal rows are drawn by Poisson(n).
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.session import workspace

# What the fits here know of an estimator. Any other parameter is left to MLlib's own fit.
PARAMS = {
    "numTrees", "maxIter", "seed", "maxDepth", "maxBins", "stepSize", "minInfoGain", "minInstancesPerNode",
}
DEEPEST = 8  # a level's sums are held at once; MLlib deals out the nodes of deeper trees
SPLIT_RANKS = 10_000  # MLlib's number of rows that candidate splits are taken from
SKETCH_SIZE = 1 << 14
COUNTED_AT_ONCE = 1 << 18
BLOCK = 1 << 16
EPSILON = 2.0**-52


@dataclass
class Bins:
    """Split points per feature, and where each feature's bin stands in a packed key."""

    splits: list[np.ndarray]
    shifts: list[int] = field(init=False)
    bits: int = field(init=False)

    def __post_init__(self):
        at, self.shifts = 1, []  # bit 0 is the label
        for splits in self.splits:
            self.shifts.append(at)
            at += len(splits).bit_length()
        self.bits = at

    @property
    def width(self) -> int:
        return max(len(splits) for splits in self.splits) + 1


class BinnedRows:
    """Labelled rows as blocks of counted bins, made when the first fit asks for them and kept
    for those that follow, until ``release``."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str):
        self.df = df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias(label))
        self.features, self.label = list(features), label
        self._made: dict[int, tuple[Bins, RDD] | None] = {}

    def blocks(self, max_bins: int) -> tuple[Bins, RDD] | None:
        """None for rows that are left to MLlib: it refuses them, or fits other classes than two."""
        if max_bins not in self._made:
            splits = candidate_splits(self.df, self.features, self.label, max_bins)
            bins = splits and Bins(splits)
            fits = bins and bins.bits <= 63 and 1 < bins.width <= 256
            self._made[max_bins] = (bins, counted_blocks(self.df, bins)) if fits else None
        return self._made[max_bins]

    def release(self) -> None:
        for _, blocks in filter(None, self._made.values()):
            blocks.unpersist()
        self._made.clear()


def fit_trees(estimator, rows: BinnedRows):
    """The fitted forest or boosted trees, or None if they are left to MLlib's own fit."""
    deep, odd = estimator.getMaxDepth() > DEEPEST, {p.name for p in estimator._paramMap} - PARAMS
    odd -= {estimator.featuresCol.name, estimator.labelCol.name}
    found = None if deep or odd else rows.blocks(estimator.getMaxBins())
    if found is None:
        return None
    bins, blocks = found
    if isinstance(estimator, RandomForestClassifier):
        trees = _fit_forest(blocks, bins, estimator)
    elif isinstance(estimator, GBTClassifier):
        trees = _fit_boosted(blocks, bins, estimator)
    else:
        raise ValueError(f"{type(estimator).__name__} is not of trees")
    return _as_mllib(estimator, trees, bins)


# Split points


def candidate_splits(
    df: DataFrame, features: Sequence[str], label: str, max_bins: int
) -> list[np.ndarray] | None:
    """MLlib's candidate splits per feature, from a quantile sketch of all rows where MLlib takes
    a sample of them.

    Up to ``SPLIT_RANKS`` rows the sketch holds them all and the splits are exactly MLlib's; above,
    it is off by 0.0005 of the rows and a little otherwise each time, as a sample is. None if a
    value or label is missing, or the labels are not the two classes 0 and 1.
    """
    spark, missing = df.sparkSession, F.lit(False)
    for name in features:
        missing = missing | F.col(name).isNull() | F.isnan(name)
    odd = F.coalesce(~F.col(label).isin(0.0, 1.0), F.lit(True))
    seen = df.agg(
        F.count("*").alias("__rows"), F.count_if(missing | odd).alias("__odd"), F.max(label).alias("__most"),
        *[F.kll_sketch_agg_double(name, F.lit(SKETCH_SIZE)).alias(name) for name in features],
    )
    with workspace(spark) as work:
        seen = work.stored(seen, "splits")
        rows, odd_rows, most = seen.select("__rows", "__odd", "__most").first()
        if odd_rows or most != 1.0:
            return None
        ranks = min(rows, max(max_bins * max_bins, SPLIT_RANKS))
        places = _ranks(spark, ranks)
        found = seen.select(*[F.kll_sketch_get_quantile_double(name, places).alias(name) for name in features]).first()
    return [_splits_of(np.array(found[name]), min(max_bins, rows) - 1) for name in features]


def _ranks(spark: SparkSession, ranks: int) -> Column:
    """The middles of so many equal parts of the ranks from 0 to 1, as one literal: as one
    expression each, they would take longer to plan than the query to run."""
    middles = array("d", ((i + 0.5) / ranks for i in range(ranks)))
    sc = spark.sparkContext
    return Column(sc._jvm.org.apache.spark.sql.functions.lit(_py2java(sc, middles)))


def _splits_of(values: np.ndarray, most: int) -> np.ndarray:
    """Points that part the values into up to ``most`` + 1 groups of about the same size."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride = len(values) / (most + 1)
    upto, target, chosen = np.cumsum(counts), stride, []
    for at, middle in enumerate(middles):
        if abs(upto[at] - target) < abs(upto[at + 1] - target):
            chosen.append(middle)
            target += stride
    return np.array(chosen)


# Blocks


def counted_blocks(df: DataFrame, bins: Bins) -> RDD:
    """Blocks (bins by feature, label, count), persisted. Each key is in one of them.

    Keys are dealt out by hash and sorted, so a fit takes its sums in the same order each time.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    keys = df.mapInArrow(partial(_counted_keys, bins=bins), "key bigint, n bigint")
    cells = keys.repartition(parts, "key").groupBy("key").agg(F.sum("n").alias("n"))
    packed = cells.sortWithinPartitions("key").mapInArrow(
        partial(_packed, bins=bins), "bins binary, label binary, n binary"
    )
    blocks = packed.rdd.map(partial(_unpacked, features=len(bins.splits)))
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def _counted_keys(batches: Iterable[pa.RecordBatch], bins: Bins) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def counted() -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "n": pa.array(n, pa.int64())})

    for batch in batches:
        *columns, label = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        key = label.astype(np.int64)
        for splits, shift, column in zip(bins.splits, bins.shifts, columns, strict=True):
            key |= np.searchsorted(splits, column, "left").astype(np.int64) << shift
        held.append(key)
        size += len(key)
        if size >= COUNTED_AT_ONCE:
            yield counted()
            held, size = [], 0
    if size:
        yield counted()


def _packed(batches: Iterable[pa.RecordBatch], bins: Bins) -> Iterator[pa.RecordBatch]:
    def block(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        masks = [(1 << len(splits).bit_length()) - 1 for splits in bins.splits]
        places = [((keys >> shift) & mask).astype(np.uint8) for shift, mask in zip(bins.shifts, masks)]
        parts = (np.stack(places).tobytes(), (keys & 1).astype(np.uint8).tobytes(), n.astype(np.float64).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["bins", "label", "n"])

    held, size = [], 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += len(batch)
        if size >= BLOCK:
            keys, n = map(np.concatenate, zip(*held))
            for at in range(0, size - BLOCK + 1, BLOCK):
                yield block(keys[at : at + BLOCK], n[at : at + BLOCK])
            rest = size - size % BLOCK
            held, size = [[keys[rest:], n[rest:]]], size % BLOCK
    if size:
        yield block(*map(np.concatenate, zip(*held)))


def _unpacked(row, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (
        np.frombuffer(row["bins"], np.uint8).reshape(features, -1),
        np.frombuffer(row["label"], np.uint8),
        np.frombuffer(row["n"], np.float64),
    )


# Growing


@dataclass
class Node:
    """A node by its place in a binary heap, root 1. ``stats`` are its sums: rows by class, or
    rows, targets and squared targets."""

    stats: np.ndarray
    impurity: float
    gain: float = 0.0
    feature: int = -1
    split: int = -1
    valid: bool = True


Tree = dict[int, Node]


@dataclass
class Growth:
    """What a pass over the rows needs to sum one level of a tree: the splits so far by place,
    the row of sums of each open node (the last is for rows in none) and its features."""

    level: int
    feature: np.ndarray
    split: np.ndarray
    slot: np.ndarray
    subset: np.ndarray


def _gini(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(-1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(total[..., 0] > 0, 1.0 - ((stats / total) ** 2).sum(-1), 0.0)


def _variance(stats: np.ndarray) -> np.ndarray:
    n, total, squares = (stats[..., i] for i in range(3))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(n > 0, (squares - total * total / n) / n, 0.0)


def _steps(tree: Tree, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature and split by place. A row at a leaf walks on to the left, to a place of its own."""
    feature, split = np.zeros(1 << depth, np.int64), np.full(1 << depth, 255, np.int64)
    for place, node in tree.items():
        if node.feature >= 0:
            feature[place], split[place] = node.feature, node.split
    return feature, split


def _growth(tree: Tree, level: int, open_nodes: list[int], subset: np.ndarray) -> Growth:
    feature, split = _steps(tree, level)
    slot = np.full(1 << (level + 1), len(open_nodes), np.int64)
    slot[open_nodes] = np.arange(len(open_nodes))
    return Growth(level, feature, split, slot, subset)


def _places(bins: np.ndarray, feature: np.ndarray, split: np.ndarray, levels: int) -> np.ndarray:
    """Place in the heap of every row of a block after so many levels."""
    size = bins.shape[1]
    flat, row = bins.reshape(-1), np.arange(size)
    place = np.ones(size, np.int64)
    for _ in range(levels):
        place = 2 * place + (flat[feature[place] * size + row] > split[place])
    return place


def _split_level(
    tree: Tree, open_nodes: list[int], subset: np.ndarray, sums: np.ndarray, bins: Bins, params: dict, deepest: bool
) -> list[int]:
    """Split the open nodes by their sums (node, feature of the subset, bin, statistic). Returns
    the children that are open in turn."""
    impurity, count, opened = params["impurity"], params["count"], []
    for at, place in enumerate(open_nodes):
        if place not in tree:  # a root
            total = sums[at, 0].sum(0)
            tree[place] = Node(total, float(impurity(total)))
        node, best = tree[place], None
        for chosen, feature in enumerate(subset[at]):
            splits = len(bins.splits[feature])
            if not splits:
                continue
            upto = np.cumsum(sums[at, chosen, : splits + 1], axis=0)
            left, right = upto[:-1], upto[-1] - upto[:-1]
            n, m = count(left), count(right)
            left_impurity, right_impurity = impurity(left), impurity(right)
            gain = node.impurity - n / (n + m) * left_impurity - m / (n + m) * right_impurity
            least = params["least"]
            gain = np.where((n < least) | (m < least) | (gain < params["min_gain"]), -math.inf, gain)
            first = int(np.argmax(gain))
            if best is None or gain[first] > best[0]:
                best = (float(gain[first]), int(feature), first, left[first], right[first],
                        float(left_impurity[first]), float(right_impurity[first]))
        node.valid = best is not None and best[0] > -math.inf
        if not node.valid or best[0] <= 0:
            continue
        node.gain, node.feature, node.split = best[:3]
        for child, stats, own in ((2 * place, best[3], best[5]), (2 * place + 1, best[4], best[6])):
            tree[child] = Node(stats, own)
            if not deepest and abs(own) >= EPSILON:
                opened.append(child)
    return opened


# Forest


def _fit_forest(blocks: RDD, bins: Bins, estimator) -> list[Tree]:
    count, depth, seed = estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed()
    features = len(bins.splits)
    # As "auto" has it: all features for a single tree, the root of their number for a forest.
    chosen = features if count == 1 else math.ceil(math.sqrt(features))
    drawn = np.random.default_rng([abs(seed), 0])
    params = _params(estimator, _gini, lambda stats: stats.sum(-1))
    trees: list[Tree] = [{} for _ in range(count)]
    open_nodes = [[1] for _ in range(count)]
    for level in range(depth):
        growing = [t for t in range(count) if open_nodes[t]]
        if not growing:
            break
        plan = {}
        for t in growing:
            subset = [np.sort(drawn.choice(features, chosen, replace=False)) for _ in open_nodes[t]]
            plan[t] = _growth(trees[t], level, open_nodes[t], np.array(subset))
        work = partial(_forest_sums, plan=plan, width=bins.width, seed=abs(seed))
        sums, at = blocks.mapPartitionsWithIndex(work).treeReduce(np.add), 0
        for t, growth in plan.items():
            shape = (len(open_nodes[t]) + 1, chosen, bins.width, 2)
            own = sums[at : at + math.prod(shape)].reshape(shape)
            at += math.prod(shape)
            open_nodes[t] = _split_level(
                trees[t], open_nodes[t], growth.subset, own, bins, params, level == depth - 1
            )
    for tree in trees:
        if not tree:
            raise RuntimeError("a tree without a root")
    return trees


def _forest_sums(part: int, blocks: Iterable, plan: dict[int, Growth], width: int, seed: int) -> Iterator[np.ndarray]:
    """Rows by (tree, node, feature, bin, class) of a part's blocks: whole numbers, exact in any order.
    A block draws the same rows for a tree at every level."""
    total = None
    for number, (bins, label, n) in enumerate(blocks):
        size = bins.shape[1]
        flat, row, found = bins.reshape(-1), np.arange(size), []
        for t, growth in plan.items():
            drawn = np.random.default_rng([seed, 1 + t, part, number]).poisson(n).astype(np.float64)
            slot = growth.slot[_places(bins, growth.feature, growth.split, growth.level)]
            nodes, chosen = len(growth.subset) + 1, growth.subset.shape[1]
            subset = np.vstack([growth.subset, np.zeros((1, chosen), np.int64)])
            sums = np.empty((nodes, chosen, width, 2))
            for k in range(chosen):
                place = flat[subset[:, k][slot] * size + row]
                cell = (slot * width + place) * 2 + label
                sums[:, k] = np.bincount(cell, drawn, nodes * width * 2).reshape(nodes, width, 2)
            found.append(sums.reshape(-1))
        found = np.concatenate(found)
        total = found if total is None else total + found
    if total is not None:
        yield total


# Boosting


def _fit_boosted(blocks: RDD, bins: Bins, estimator) -> list[Tree]:
    """Trees one after the other, each on the gradient of the log loss at the sum of those before."""
    depth, rounds = estimator.getMaxDepth(), estimator.getMaxIter()
    params = _params(estimator, _variance, lambda stats: stats[..., 0])
    everything = np.arange(len(bins.splits))
    trees: list[Tree] = []
    state, before = blocks.map(_first_targets), None
    try:
        for number in range(rounds):
            tree, open_nodes = {}, [1]
            for level in range(depth):
                if not open_nodes:
                    break
                subset = np.tile(everything, (len(open_nodes), 1))
                growth = _growth(tree, level, open_nodes, subset)
                work = partial(_boosted_sums, growth=growth, width=bins.width)
                parts = sorted(state.mapPartitionsWithIndex(work).collect(), key=lambda found: found[0])
                if before is not None:  # the first pass over the new state has stored it
                    before.unpersist()
                    before = None
                sums = sum(found for _, found in parts)
                open_nodes = _split_level(tree, open_nodes, subset, sums, bins, params, level == depth - 1)
            trees.append(tree)
            if number + 1 < rounds:
                weight = _tree_weights(estimator, number + 1)[-1]
                before = state if number else None
                state = _moved(state, tree, depth, weight)
    finally:
        for kept in (state, before):
            if kept is not None and kept.is_cached:
                kept.unpersist()
    return trees


def _tree_weights(estimator, rounds: int) -> list[float]:
    return [1.0, *[estimator.getStepSize()] * (rounds - 1)][:rounds]


def _moved(state: RDD, tree: Tree, depth: int, weight: float) -> RDD:
    """The state after one more tree, stored by the first pass over it."""
    feature, split = _steps(tree, depth)
    value = np.zeros(1 << (depth + 1))
    for place, node in tree.items():
        if node.feature < 0:
            value[place << (depth - place.bit_length() + 1)] = node.stats[1] / node.stats[0]
    step = partial(_step, feature=feature, split=split, value=value * weight, depth=depth)
    return state.map(step).persist(StorageLevel.MEMORY_AND_DISK)


def _first_targets(block: tuple) -> tuple:
    bins, label, n = block
    return bins, label, n, np.zeros(len(n)), label * 2.0 - 1.0


def _step(block: tuple, feature: np.ndarray, split: np.ndarray, value: np.ndarray, depth: int) -> tuple:
    bins, label, n, score, _ = block
    score = score + value[_places(bins, feature, split, depth)]
    sign = label * 2.0 - 1.0
    with np.errstate(over="ignore"):
        return bins, label, n, score, 4.0 * sign / (1.0 + np.exp(2.0 * sign * score))


def _boosted_sums(part: int, blocks: Iterable, growth: Growth, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows, targets and their squares by (node, feature, bin) of a part's blocks."""
    total = None
    for bins, _, n, _, target in blocks:
        slot = growth.slot[_places(bins, growth.feature, growth.split, growth.level)]
        nodes, features = len(growth.subset) + 1, growth.subset.shape[1]
        sums = np.empty((nodes, features, width, 3))
        first = slot * width
        weighted = n * target
        measures = (n, weighted, weighted * target)
        for k in range(features):
            cell = first + bins[k]
            for i, measure in enumerate(measures):
                sums[:, k, :, i] = np.bincount(cell, measure, nodes * width).reshape(nodes, width)
        total = sums if total is None else total + sums
    if total is not None:
        yield part, total


def _params(estimator, impurity, count) -> dict:
    return {
        "impurity": impurity, "count": count, "least": estimator.getMinInstancesPerNode(),
        "min_gain": estimator.getMinInfoGain(),
    }


# MLlib models


def _as_mllib(estimator, trees: list[Tree], bins: Bins):
    """The trees as the model that the estimator's own fit returns."""
    spark = SparkSession.active()
    sc, features = spark.sparkContext, len(bins.splits)
    ml = sc._jvm.org.apache.spark.ml
    boosted = isinstance(estimator, GBTClassifier)
    estimator._transfer_params_to_java()
    parent = estimator._java_obj
    kind = ml.regression.DecisionTreeRegressionModel if boosted else ml.classification.DecisionTreeClassificationModel
    made = sc._gateway.new_array(kind, len(trees))
    for i, tree in enumerate(trees):
        root = _mllib_root(sc, tree, bins, boosted)
        args = (f"{parent.uid()}_{i}", root, features)
        made[i] = kind(*args) if boosted else kind(*args, 2)
    if boosted:
        weights = _py2java(sc, array("d", _tree_weights(estimator, len(trees))))
        fitted = ml.classification.GBTClassificationModel(parent.uid(), made, weights, features, 2)
    else:
        fitted = ml.classification.RandomForestClassificationModel(parent.uid(), made, features, 2)
    fitted = parent.copyValues(fitted.setParent(parent), ml.param.ParamMap())
    return estimator._copyValues(estimator._create_model(fitted))


def _mllib_root(sc, tree: Tree, bins: Bins, boosted: bool):
    """A tree as MLlib's nodes. Two leaves of one answer become one, as in its own fit."""
    jvm = sc._jvm.org.apache.spark
    impurities = jvm.mllib.tree.impurity
    calculator = impurities.VarianceCalculator if boosted else impurities.GiniCalculator
    places = list(tree)
    sums = dict(zip(places, _py2java(sc, [array("d", tree[place].stats) for place in places])))

    def answer(node: Node) -> float:
        return float(node.stats[1] / node.stats[0] if boosted else np.argmax(node.stats))

    def built(place: int):
        node = tree[place]
        rows = round(node.stats[0] if boosted else node.stats.sum())
        own = calculator(sums[place], rows)
        if node.feature < 0:
            return jvm.ml.tree.LeafNode(answer(node), node.impurity if node.valid else -1.0, own), answer(node)
        (left, said), (right, other) = built(2 * place), built(2 * place + 1)
        if said is not None and said == other:
            return jvm.ml.tree.LeafNode(said, node.impurity, own), said
        split = jvm.ml.tree.ContinuousSplit(node.feature, float(bins.splits[node.feature][node.split]))
        return jvm.ml.tree.InternalNode(answer(node), node.impurity, node.gain, left, right, split, own), None

    return built(1)[0]
