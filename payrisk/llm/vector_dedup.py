"""Near-duplicate vectors by sorted projection passes.

Equal vectors are one class. Each pass gives every class 64 random hyperplane signs, sorts the
classes by them (first sign first) and compares each with the ``WINDOW`` classes behind it. Two
vectors at cosine 0.9 agree in one sign with probability 0.856, and need to agree in about
log2(classes / window) signs to come near enough: the number of passes follows from the table's
size, so that such a pair is met with probability ``RECALL``. A task gives out only links that
connect what its window has not connected yet, so a crowd of near copies yields as many links
as rows. The verified pairs of all passes are united into components.

Windows are bounded, so in a crowd they meet few of the links. Every link lies inside one
component, therefore links are counted there exhaustively: components are cut into cells of
neighbouring classes; two cells whose balls are near or far enough count as all or nothing,
and only the others are multiplied out. No pair of vectors is given out for it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.llm.common import stored, table
from payrisk.llm.components import components

LEAST_COSINE = 0.9
WINDOW = 32
RECALL = 0.99
PASSES_AT_A_TIME = 4
CELL = 1024  # classes of one cell at most
TILE = 256  # cells that are held against others at a time
TASK_BYTES = 16 << 20
SLACK = 1e-6  # of angles, far above their rounding

LINKS = "a bigint, b bigint"
CELLS = (
    "label bigint, cell bigint, weight bigint, radius double, centre binary, dim int, "
    "cids array<bigint>, weights array<bigint>, inner array<bigint>, vectors binary"
)


def passes(classes: int, least: float = LEAST_COSINE) -> int:
    """Passes that meet a pair at the limit with probability ``RECALL``, of so many classes."""
    agree = 1 - math.acos(least) / math.pi
    once = agree ** math.log2(max(classes, 2 * WINDOW) / WINDOW)
    return math.ceil(math.log(1 - RECALL) / math.log(1 - once))


def _digests(batches: Iterator[pa.RecordBatch], key: str, kind: str) -> Iterator[pa.RecordBatch]:
    """The id, and of vectors that can link their bytes and digest; null of all others."""
    for batch in batches:
        column = batch.column("vector")
        lists = column.to_pylist() if column.flatten().null_count else None
        flat = np.asarray(column.flatten()).astype(kind) if lists is None else None
        sizes = np.asarray(column.value_lengths().fill_null(0))
        upto = np.concatenate([[0], np.cumsum(sizes)])
        data: list[bytes | None] = []
        for row in range(batch.num_rows):
            if lists is None:
                own = flat[upto[row] : upto[row + 1]]
            else:
                own = np.array([np.nan if v is None else v for v in lists[row] or []], dtype=kind)
            good = len(own) and np.isfinite(own).all() and own.any()
            data.append((own + 0.0).tobytes() if good else None)  # -0.0 becomes 0.0
        digests = [None if d is None else hashlib.blake2b(d, digest_size=16).digest() for d in data]
        yield pa.RecordBatch.from_arrays(
            [batch.column(key), pa.array(digests, pa.binary()), pa.array(data, pa.binary())],
            names=[key, "digest", "vector"],
        )


def _units(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    """Vectors of one dimension as rows of length 1, in double precision."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    rows = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]].view(kind).reshape(-1, dim).astype(np.float64)
    rows /= np.abs(rows).max(axis=1)[:, None]  # so that squares neither overflow nor vanish
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    return rows


def _keys(units: np.ndarray, turn: int) -> np.ndarray:
    """64 signs of random projections as numbers that sort like the signs, first sign first."""
    planes = np.random.default_rng([turn, units.shape[1]]).standard_normal((units.shape[1], 64))
    signs = np.packbits(units @ planes > 0, axis=1)
    return (signs.view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of stretches in which all columns stay the same."""
    n = len(columns[0])
    change = np.zeros(max(n - 1, 0), dtype=bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
    return [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def _keyed(batches: Iterator[pa.RecordBatch], kind: str, turns: list[int]) -> Iterator[pa.RecordBatch]:
    """Every row once per turn, with the turn's key."""
    for batch in batches:
        dims = np.asarray(batch.column("dim"))
        for dim in np.unique(dims).tolist():
            own = batch.filter(pa.array(dims == dim))
            units = _units(own.column("vector"), kind, dim)
            for turn in turns:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(units), turn), pa.int32()), pa.array(_keys(units, turn)), *own.columns],
                    names=["turn", "key", *own.schema.names],
                )


def _spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of every row the least row that the pairs (i, j) connect it with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def _windows(batches: Iterator[pa.RecordBatch], kind: str, least: float) -> Iterator[pa.RecordBatch]:
    """Links within windows of rows sorted by turn, dimension and key, as spanning pairs.

    The last rows of a batch are held against the next batch. What a task's border parts is
    left to the other passes.
    """
    held, units, ids = None, None, None
    for batch in batches:
        turn, dim, cid = (np.asarray(batch.column(c)) for c in ("turn", "dim", "cid"))
        for a, b in _runs(turn, dim):
            own, cids = _units(batch.column("vector").slice(a, b - a), kind, int(dim[a])), cid[a:b]
            if held == (turn[a], dim[a]):
                own, cids = np.concatenate([units, own]), np.concatenate([ids, cids])
            left, right = [], []
            for s in range(0, len(own), 256):
                near = own[s : s + 256] @ own[s : s + 256 + WINDOW].T >= least
                i, j = np.nonzero(near)
                inside = (j > i) & (j - i <= WINDOW)
                left.append(i[inside] + s)
                right.append(j[inside] + s)
            label = _spanning(len(own), np.concatenate(left), np.concatenate(right))
            linked = np.flatnonzero(label != np.arange(len(own)))
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cids[linked]), pa.array(cids[label[linked]])], names=["a", "b"]
                )
            held, units, ids = (turn[a], dim[a]), own[-WINDOW:], cids[-WINDOW:]


def _cell_row(label: int, number: int, dim: int, cids, weights, units: np.ndarray, least: float) -> dict:
    centre = units.mean(axis=0)
    size = np.linalg.norm(centre)
    centre = centre / size if size > 1e-9 else units[0]
    radius = float(np.arccos(np.clip(units @ centre, -1, 1)).max())
    inner = (units @ units.T >= least).astype(np.int64) @ weights
    return {
        "label": label, "cell": number, "weight": int(weights.sum()), "radius": radius,
        "centre": centre.tobytes(), "dim": dim, "cids": cids, "weights": weights, "inner": inner,
        "vectors": units.tobytes(),
    }


def _cells(batches: Iterator[pa.RecordBatch], kind: str, least: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Cells of rows sorted by component and key, each with the links within it counted."""
    number = TaskContext.get().partitionId() << 32
    held: tuple | None = None
    for batch in batches:
        label, dim, cid, weight = (np.asarray(batch.column(c)) for c in ("label", "dim", "cid", "weight"))
        rows = []
        for a, b in _runs(label):
            own = (cid[a:b], weight[a:b], _units(batch.column("vector").slice(a, b - a), kind, int(dim[a])))
            if held is not None and held[0] == label[a]:
                own = tuple(np.concatenate(pair) for pair in zip(held[2], own, strict=True))
            elif held is not None:
                rows.append(_cell_row(held[0], number, held[1], *held[2], least))
                number += 1
            while len(own[0]) > CELL:
                rows.append(_cell_row(label[a], number, dim[a], *(x[:CELL] for x in own), least))
                number += 1
                own = tuple(x[CELL:] for x in own)
            held = (label[a], dim[a], own)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)
    if held is not None:
        yield pa.RecordBatch.from_pylist([_cell_row(held[0], number, held[1], *held[2], least)], schema)


def _judge(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Of two tiles of cells: (cell, null, weight) links to all of a cell's other cells that lie
    near enough, (cell, other, 0) pairs of cells that have to be multiplied out."""
    limit = math.acos(least)
    for batch in batches:
        for row in batch.to_pylist():
            x, y = ({k: [c[k] for c in side] for k in side[0]} for side in (row["x"], row["y"]))
            cx, cy = (np.frombuffer(b"".join(side["centre"])).reshape(-1, row["dim"]) for side in (x, y))
            angle = np.arccos(np.clip(cx @ cy.T, -1, 1))
            reach = np.array(x["radius"])[:, None] + np.array(y["radius"])[None, :]
            names_x, names_y = np.array(x["cell"]), np.array(y["cell"])
            pair = names_x[:, None] < names_y[None, :] if row["same"] else np.ones(angle.shape, dtype=bool)
            full = pair & (angle + reach <= limit - SLACK)
            open_ = pair & ~full & (angle - reach <= limit + SLACK)
            i, j = np.nonzero(open_)
            cells = np.concatenate([names_x, names_y, names_x[i]])
            other = np.concatenate([np.zeros(len(names_x) + len(names_y), dtype=np.int64), names_y[j]])
            whole = np.arange(len(cells)) < len(names_x) + len(names_y)
            add = np.concatenate([full @ np.array(y["weight"]), np.array(x["weight"]) @ full, np.zeros(len(i))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), pa.array(other, mask=whole), pa.array(add.astype(np.int64))],
                names=["cell", "other", "add"],
            )


def _between(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(cid, add): links between the members of two cells, by member."""
    for batch in batches:
        for row in batch.to_pylist():
            x, y = (np.frombuffer(row[c]).reshape(-1, row["dim"]) for c in ("vx", "vy"))
            near = (x @ y.T >= least).astype(np.int64)
            cids = np.array([*row["ix"], *row["iy"]], dtype=np.int64)
            add = np.concatenate([near @ np.array(row["wy"]), np.array(row["wx"]) @ near])
            yield pa.RecordBatch.from_arrays([pa.array(cids[add > 0]), pa.array(add[add > 0])], names=["cid", "add"])


def _sorted(df: DataFrame, of_bytes: int, *by: str) -> DataFrame:
    tasks = max(1, -(-of_bytes // TASK_BYTES))
    return df.repartitionByRange(tasks, *by).sortWithinPartitions(*by)


def window_links(classes: DataFrame, kind: str, least: float, count: int, of_bytes: int) -> DataFrame:
    """(a, b): spanning links of every pass."""
    found, total = [], passes(count, least)
    for first in range(0, total, PASSES_AT_A_TIME):
        turns = list(range(first, min(first + PASSES_AT_A_TIME, total)))
        keyed = classes.select("cid", "dim", "vector").mapInArrow(
            partial(_keyed, kind=kind, turns=turns), "turn int, key bigint, cid bigint, dim int, vector binary"
        )
        near = _sorted(keyed, of_bytes * len(turns), "turn", "dim", "key", "cid")
        found.append(stored(near.mapInArrow(partial(_windows, kind=kind, least=least), LINKS), "vector-links"))
    return reduce(DataFrame.unionByName, found).distinct()


def link_counts(members: DataFrame, kind: str, least: float, of_bytes: int) -> DataFrame:
    """(cid, n): vectors within ``least`` of each class of a component, itself included."""
    keyed = members.mapInArrow(
        partial(_keyed, kind=kind, turns=[0]),
        "turn int, key bigint, label bigint, cid bigint, weight bigint, dim int, vector binary",
    )
    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [("label", pa.int64()), ("cell", pa.int64()), ("weight", pa.int64()), ("radius", pa.float64()),
         ("centre", pa.binary()), ("dim", pa.int32()), ("cids", longs), ("weights", longs), ("inner", longs),
         ("vectors", pa.binary())]
    )
    near = _sorted(keyed, of_bytes, "label", "key", "cid")
    cells = stored(near.mapInArrow(partial(_cells, kind=kind, least=least, schema=schema), CELLS), "cells")
    several = cells.groupBy("label").agg(F.count("*").alias("n")).filter("n > 1")
    several = several.select("label", F.ceil(F.col("n") / TILE).alias("tiles"))
    tiles = (
        cells.select("label", "dim", F.struct("cell", "weight", "radius", "centre").alias("one"))
        .join(several, "label")
        .groupBy("label", "dim", F.pmod(F.xxhash64("one.cell"), "tiles").alias("tile"))
        .agg(F.collect_list("one").alias("x"))
    )
    other = tiles.select("label", F.col("tile").alias("tile2"), F.col("x").alias("y"))
    pairs = tiles.join(other, "label").filter("tile <= tile2")
    judged = pairs.select("dim", "x", "y", (F.col("tile") == F.col("tile2")).alias("same")).mapInArrow(
        partial(_judge, least=least), "cell bigint, other bigint, add bigint"
    )
    judged = stored(judged, "cell-pairs")
    whole = judged.filter("other IS NULL").groupBy("cell").agg(F.sum("add").alias("whole"))
    x = cells.select("cell", "dim", F.col("cids").alias("ix"), F.col("weights").alias("wx"), F.col("vectors").alias("vx"))
    y = cells.select(F.col("cell").alias("other"), F.col("cids").alias("iy"), F.col("weights").alias("wy"), F.col("vectors").alias("vy"))
    open_ = judged.filter("other IS NOT NULL").select("cell", "other")
    between = (
        open_.join(x, "cell").join(y, "other").drop("cell", "other")
        .mapInArrow(partial(_between, least=least), "cid bigint, add bigint")
        .groupBy("cid").agg(F.sum("add").alias("between"))
    )
    inner = cells.select("cell", F.inline(F.arrays_zip("cids", "inner")))
    return (
        inner.join(whole, "cell", "left")
        .join(between, F.col("cids") == F.col("cid"), "left")
        .select(
            F.col("cids").alias("cid"),
            (F.col("inner") + F.coalesce("whole", F.lit(0)) + F.coalesce("between", F.lit(0))).alias("n"),
        )
    )


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per row of ``vectors``.

    Reads vec_id, of any type that has an order, and embedding, an array of numbers. Vectors
    that are null, empty, zero or hold a null or non-finite component link with nothing, those
    of different lengths not with each other. Repeated rows are vectors of their own that link.
    A null id is never the smallest of a component that has another. Other columns are not
    read; an empty table gives an empty table.
    """
    id_kind = vectors.schema["vec_id"].dataType.simpleString()
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "f4" if single else "f8"
    rows = vectors.select("vec_id", F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"))
    marked = rows.mapInArrow(
        partial(_digests, key="vec_id", kind=kind), f"vec_id {id_kind}, digest binary, vector binary"
    )
    classes = (
        marked.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
        .withColumn("dim", (F.length("vector") / (4 if single else 8)).cast("int"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = stored(classes, "vector-classes")
    count, of_bytes = classes.agg(F.count("*"), F.coalesce(F.sum(F.length("vector") + 40), F.lit(0))).first()
    labels = components(window_links(classes, kind, least, count, of_bytes))
    members = classes.join(labels, F.col("cid") == F.col("node")).select("label", "cid", "weight", "dim", "vector")
    counts = link_counts(members, kind, least, of_bytes)
    named = classes.select("digest", "cid", "low", "weight").join(
        labels, F.col("cid") == F.col("node"), "left"
    )
    named = named.withColumn("label", F.coalesce("label", "cid"))
    lows = named.groupBy("label").agg(F.min("low").alias("component_id"))
    found = (
        named.join(lows, "label").join(counts, "cid", "left")
        .select(
            F.col("digest").alias("own"), "component_id",
            (F.coalesce("n", "weight") - 1).alias("n_links"),
        )
    )
    found = stored(found, "vector-groups")
    keys = marked.select("vec_id", "digest")
    linked = keys.filter("digest IS NOT NULL").join(found, F.col("digest") == F.col("own")).select(
        "vec_id", "n_links", "component_id"
    )
    alone = keys.filter("digest IS NULL").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
