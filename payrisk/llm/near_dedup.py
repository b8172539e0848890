"""Near duplicates by a chosen-path set similarity join.

Texts of one shingle set are one class. Classes are branched recursively: in every node each
class goes to the children named by its minwise tokens at two positions that the node's path
chooses. Two classes of similarity s part at one position with probability 1 - s, so a tree
loses a pair of similarity 0.8 with probability 0.0625 at most however deep it grows; ``TREES``
independent trees leave 6e-8. Nodes small enough are compared exhaustively.

Nodes are compared by their minwise tokens first, within tasks. What comes out are spanning
pairs that may be similar, at most one a class and node, however many pairs there are: they
tie classes together to families. A node that stays large after ``MAX_DEPTH`` levels (copies
of one page in thousands) is held against pivots first; then only the classes outside its
largest family meet the others, in blocks.

Every link lies inside a family. A family's whole sets meet once, again in blocks if it is
large, and links are confirmed on them: a class already tied to the main component is not
compared again, all others are compared with the whole family. So pairs are neither written
out nor shuffled, and no component is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.llm.common import stored, text_or_empty
from payrisk.llm.components import components
from payrisk.llm.tokens import U64, distinct_by_row, mixed, parts, random64, shingles, signed, words
from payrisk.session import workspace

TOKENS = 48  # minwise tokens kept per class
TREES = 6
BRANCHES = 2
SMALL_NODE = 32
PIVOTS = 2
MAX_DEPTH = 3
BLOCK = 2048  # classes of a node that are compared at a time
SET_BYTES = 16 << 20  # of the sets that are compared at a time
# Pairs that share fewer minwise tokens are not looked at: five deviations below the mean
# at similarity 0.8, so one true pair in ten million.
LEAST_SHARED = 24
SIMILARITY_PCT = 80
BITMAP_BITS = 1 << 15  # of one bitmap of Spark's
MARK_BUCKETS = 1 << 11  # bitmaps of the rows that go: 8 MB at most are broadcast

LINKS = "a bigint, b bigint"
_XOR, _ODD = random64(TOKENS, 11), random64(TOKENS, 12) | U64(1)


def _sketch(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch.column("text")):
            values, first = distinct_by_row(*shingles(words(part), k))
            sizes = np.diff(first)
            full = np.flatnonzero(sizes)
            at = first[:-1][full]
            tokens = np.zeros((len(sizes), TOKENS), dtype=np.int32)
            digests = np.zeros((2, len(sizes)), dtype=U64)
            if len(at):
                for t in range(TOKENS):
                    hashed = values ^ _XOR[t]
                    hashed *= _ODD[t]
                    hashed >>= U64(32)
                    tokens[full, t] = np.minimum.reduceat(hashed, at).astype(np.uint32).view(np.int32)
                digests[0, full] = np.add.reduceat(values, at)
                digests[1, full] = np.add.reduceat(mixed(values), at)
            rows = batch.slice(part.first, part.last - part.first)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(tokens.ravel()), TOKENS)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("text_hash"),
                    pa.array(sizes),
                    pa.array(signed(digests[0])),
                    pa.array(signed(digests[1])),
                    lists.cast(pa.list_(pa.int32())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "d1", "d2", "tokens"],
            )


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch.column("text")):
            values, first = distinct_by_row(*shingles(words(part), k))
            sets = [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            rows = batch.slice(part.first, part.last - part.first)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in ("family", "cid", "blocks")), pa.array(sets, pa.binary())],
                names=["family", "cid", "blocks", "members"],
            )


def _child(path: Column, i: Column) -> Column:
    return F.xxhash64(path, i, F.element_at("tokens", (i + 1).cast("int")))


def _root_rows(classes: DataFrame) -> DataFrame:
    """Every class at the first level of every tree; each tree starts at positions of its own."""
    starts = F.array(
        *[
            _child(F.lit(tree), F.lit(tree * BRANCHES + b))
            for tree in range(TREES)
            for b in range(BRANCHES)
        ]
    )
    return classes.select("cid", F.explode(starts).alias("path"))


def _branched(rows: DataFrame, classes: DataFrame) -> DataFrame:
    first = F.pmod(F.xxhash64("path"), F.lit(TOKENS))
    step = 1 + F.pmod(F.xxhash64("path", F.lit(1)), F.lit(TOKENS - 1))
    children = F.array(
        _child(F.col("path"), first), _child(F.col("path"), (first + step) % TOKENS)
    )
    return rows.join(classes.select("cid", "tokens"), "cid").select(
        "cid", F.explode(children).alias("path")
    )


def nodes(classes: DataFrame) -> DataFrame:
    """(path, cid, n): the classes of every final node of all trees, n of them, two or more."""
    rows, final = _root_rows(classes), []
    for depth in range(1, MAX_DEPTH + 1):
        counts = rows.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        held = stored(rows.join(counts, "path"), "nodes")
        if depth == MAX_DEPTH:
            final.append(held)
            break
        final.append(held.filter(F.col("n") <= SMALL_NODE))
        rows = _branched(held.filter(F.col("n") > SMALL_NODE), classes)
    return reduce(DataFrame.unionByName, [df.select("path", "cid", "n") for df in final])


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Stretches of sorted rows with equal keys, whole, also where a batch ends within one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for v in values:
            change |= v[1:] != v[:-1]
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
            held = []
        held.append(batch.slice(cuts[-1]))
    if held:
        yield pa.Table.from_batches(held)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of every row the least row that the pairs (i, j) connect it with."""
    label = np.arange(n)
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]


def _near(tokens_a, sizes_a, tokens_b, sizes_b) -> np.ndarray:
    """Which classes may be similar: enough shared tokens, and sizes that allow for it."""
    shared = np.zeros((len(tokens_a), len(tokens_b)), dtype=np.int8)
    for t in range(TOKENS):
        shared += tokens_a[:, t, None] == tokens_b[None, :, t]
    a, b = sizes_a[:, None], sizes_b[None, :]
    return (shared >= LEAST_SHARED) & (100 * np.minimum(a, b) >= SIMILARITY_PCT * np.maximum(a, b))


def _columns(table: pa.Table) -> tuple[np.ndarray, ...]:
    tokens = np.asarray(table.column("tokens").combine_chunks().flatten()).reshape(-1, TOKENS)
    return np.asarray(table.column("cid")), np.asarray(table.column("n_shingles")), tokens


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _node_ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning pairs of each node's classes that may be similar."""
    for table in _groups(batches, "path"):
        cid, sizes, tokens = _columns(table)
        left, right = [], []
        for a in range(0, len(cid), 512):
            i, j = np.nonzero(_near(tokens[a : a + 512], sizes[a : a + 512], tokens[a:], sizes[a:]))
            left.append(i[i < j] + a)
            right.append(j[i < j] + a)
        root = _roots(len(cid), np.concatenate(left), np.concatenate(right))
        tied = np.flatnonzero(root != np.arange(len(cid)))
        if len(tied):
            yield _pairs(cid[tied], cid[root[tied]])


def _block_ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that may be similar of rows sorted by node, block and role: first the block, then
    the node, which streams past it. One for each class that passes and family in the block."""
    for table in _groups(batches, "path", "part"):
        role, label = np.asarray(table.column("role")), np.asarray(table.column("label"))
        cid, sizes, tokens = _columns(table)
        own = np.flatnonzero(role == 0)
        for a in range(0, len(cid), 512):
            run = np.arange(a, min(a + 512, len(cid)))
            run = run[role[run] == 1]
            i, j = np.nonzero(_near(tokens[own], sizes[own], tokens[run], sizes[run]))
            i, j = own[i], run[j]
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            if len(i):
                _, one = np.unique(np.stack([label[i], label[j]]), axis=1, return_index=True)
                yield _pairs(cid[i[one]], cid[j[one]])


def _least(by: Column, n: int, *columns: str) -> list[Column]:
    return [F.min(F.struct(F.xxhash64(by, F.lit(s)), *columns)).alias(f"p{s}") for s in range(n)]


def _to_pivots(rows: DataFrame) -> DataFrame:
    """Ties of every class of a node with the node's pivots, where they may be similar."""
    one = ("cid", "n_shingles", "tokens")
    pivots = rows.groupBy("path").agg(*_least(F.col("cid"), PIVOTS, *one))
    pivots = pivots.select("path", F.explode(F.array(*[F.struct(*[F.col(f"p{s}.{c}").alias(c) for c in one]) for s in range(PIVOTS)])).alias("pivot"))
    same = F.zip_with("tokens", "pivot.tokens", lambda a, b: (a == b).cast("int"))
    shared = F.aggregate(same, F.lit(0), lambda acc, v: acc + v)
    n, m = F.col("n_shingles"), F.col("pivot.n_shingles")
    near = (shared >= LEAST_SHARED) & (100 * F.least(n, m) >= SIMILARITY_PCT * F.greatest(n, m))
    held = rows.join(pivots, "path").filter((F.col("cid") != F.col("pivot.cid")) & near)
    return held.select(F.col("cid").alias("a"), F.col("pivot.cid").alias("b"))


def _across_families(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Ties within large nodes between classes outside the largest family and all others."""
    own = rows.join(labels, F.col("cid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cid"))
    own = stored(own.drop("node"), "labelled")
    sizes = own.groupBy("path", "label").agg(F.count("*").alias("n"))
    several = sizes.groupBy("path").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("labels")
    )
    several = several.filter("labels > 1").select(
        "path", F.col("top.label").alias("top"), F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("blocks")
    )
    held = own.join(several, "path")
    roles = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(k.alias("part"), F.lit(1).alias("role")),
    )
    mine = F.struct(F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int").alias("part"), F.lit(0).alias("role"))
    first = F.when(F.col("label") != F.col("top"), F.array(mine)).otherwise(F.array().cast("array<struct<part:int,role:int>>"))
    dealt = held.select("path", "cid", "label", "n_shingles", "tokens", F.inline(F.concat(first, roles)))
    return (
        dealt.repartition("path", "part").sortWithinPartitions("path", "part", "role")
        .mapInArrow(_block_ties, LINKS)
    )


def families(classes: DataFrame) -> DataFrame:
    """(node, label): classes that may be similar to others, by what ties connect."""
    members = nodes(classes)
    rows = members.join(classes.select("cid", "n_shingles", "tokens"), "cid")
    fits = rows.filter(F.col("n") <= BLOCK).drop("n").repartition("path").sortWithinPartitions("path", "cid")
    ties = fits.select("path", "cid", "n_shingles", "tokens").mapInArrow(_node_ties, LINKS)
    if members.filter(F.col("n") > BLOCK).isEmpty():
        return components(stored(ties.distinct(), "ties"))
    large = rows.filter(F.col("n") > BLOCK).drop("n")
    labels = components(stored(ties.unionByName(_to_pivots(large)).distinct(), "ties"))
    more = stored(_across_families(large, labels).distinct(), "more-ties")
    return labels if more.isEmpty() else joined_labels(labels, more)


class _Sets:
    """Sets of one task with an index from each shingle to the rows that hold it."""

    def __init__(self, members: pa.ChunkedArray):
        sets = [np.frombuffer(m.as_buffer(), dtype=U64) for chunk in members.chunks for m in chunk]
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        values = np.concatenate(sets) if sets else np.zeros(0, dtype=U64)
        order = np.argsort(values, kind="stable")
        ranked = values[order]
        new = np.ones(len(ranked), dtype=bool)
        new[1:] = ranked[1:] != ranked[:-1]
        self.keys = ranked[new]
        self.start = np.append(np.flatnonzero(new), len(ranked))
        self.holder = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.ids = np.empty(len(values), dtype=np.int64)
        self.ids[order] = np.cumsum(new) - 1

    def similar(self, ids: np.ndarray, size: int, pct: int) -> np.ndarray:
        """Rows whose sets are similar enough to a set of these indexed shingles and this size."""
        begin, end = self.start[ids], self.start[ids + 1]
        counts = end - begin
        at = np.repeat(begin - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        shared = np.bincount(self.holder[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * shared >= pct * (self.sizes + size - shared))

    def row(self, i: int) -> np.ndarray:
        return self.ids[self.first[i] : self.first[i + 1]]

    def lookup(self, values: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, values)
        at[at == len(self.keys)] = 0
        return at[self.keys[at] == values] if len(self.keys) else at[:0]


def _links(batches: Iterator[pa.RecordBatch], pct: int) -> Iterator[pa.RecordBatch]:
    """Spanning links of each block of a family, its pivots (role 0) first.

    Each row is compared with all others, unless it is in the component of the first pivots by
    then: whatever it links with outside will be compared itself.
    """
    for table in _groups(batches, "family", "part"):
        cid = np.asarray(table.column("cid"))
        sets, label = _Sets(table.column("members")), np.arange(len(cid))
        main = 0
        for row in range(len(cid)):
            if row == PIVOTS:
                main = np.bincount(label).argmax()
            if row >= PIVOTS and label[row] == main:
                continue
            near = sets.similar(sets.row(row), sets.sizes[row], pct)
            old = np.unique(label[near])
            if len(old) > 1:
                new = main if main in old else old[0]
                label[np.isin(label, old)] = new
        roots, one = np.unique(label, return_index=True)
        head = one[np.searchsorted(roots, label)]
        linked = np.flatnonzero(head != np.arange(len(cid)))
        if len(linked):
            yield _pairs(cid[linked], cid[head[linked]])


def _block_links(batches: Iterator[pa.RecordBatch], pct: int) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by family, block and role: first the block, then the family, which
    streams past it. One for each row that passes and component in the block."""
    key, block, held = None, None, []
    for batch in batches:
        family, part, role = (np.asarray(batch.column(c)) for c in ("family", "part", "role"))
        change = (family[1:] != family[:-1]) | (part[1:] != part[:-1]) | (role[1:] != role[:-1])
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for x, y in zip(bounds[:-1], bounds[1:], strict=True):
            if y == x:
                continue
            rows, own = batch.slice(x, y - x), (family[x], part[x])
            if role[x] == 0:
                held = [*held, rows] if key == own else [rows]
                key, block = own, None
                continue
            if key != own:
                continue
            if block is None:
                table = pa.Table.from_batches(held)
                block = _Sets(table.column("members")), np.asarray(table.column("cid")), np.asarray(table.column("label"))
            sets, cids, labels = block
            left, right = [], []
            for cid, label, members in zip(
                rows.column("cid").to_pylist(), rows.column("label").to_pylist(), rows.column("members"), strict=True
            ):
                values = np.frombuffer(members.as_buffer(), dtype=U64)
                near = sets.similar(sets.lookup(values), len(values), pct)
                near = near[labels[near] != label]
                if len(near):
                    near = near[np.unique(labels[near], return_index=True)[1]]
                    left.append(cids[near])
                    right.append(np.full(len(near), cid))
            if left:
                yield _pairs(np.concatenate(left), np.concatenate(right))


def _family_sets(docs: DataFrame, classes: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """(family, cid, blocks, members): whole sets of the classes of families, read once."""
    held = classes.join(labels, F.col("cid") == F.col("node")).select(
        F.col("label").alias("family"), "cid", "n_shingles", F.col("one.doc_id").alias("one_id"), F.col("one.text_hash").alias("one_hash")
    )
    sizes = held.groupBy(F.col("family").alias("f")).agg(
        F.ceil(F.sum(8 * F.col("n_shingles")) / SET_BYTES).cast("int").alias("blocks")
    )
    wanted = held.join(sizes, F.col("family") == F.col("f")).withColumn("key", F.xxhash64("one_id", "one_hash"))
    own_hash = F.xxhash64(text_or_empty())
    texts = docs.select(
        F.xxhash64("doc_id", own_hash).alias("own_key"), F.col("doc_id").alias("own_id"),
        own_hash.alias("own_hash"), text_or_empty().alias("text"),
    )
    same = (
        (F.col("own_key") == F.col("key"))
        & F.col("own_id").eqNullSafe(F.col("one_id")) & (F.col("own_hash") == F.col("one_hash"))
    )
    # Repeated rows give their class once: they lie together already.
    found = texts.join(wanted, same).dropDuplicates(["own_key", "cid"])
    return found.select("family", "cid", "blocks", "text").mapInArrow(
        partial(_sets, k=k), "family bigint, cid bigint, blocks int, members binary"
    )


def _confirmed(rows: DataFrame) -> DataFrame:
    near = rows.repartition("family", "part").sortWithinPartitions("family", "part", "role")
    links = near.drop("role").mapInArrow(partial(_links, pct=SIMILARITY_PCT), LINKS)
    return stored(links.filter("a != b").distinct(), "links")


def confirmed_labels(docs: DataFrame, classes: DataFrame, ties: DataFrame, k: int) -> DataFrame:
    """(node, label): components of the links that whole sets confirm within the families."""
    sets = stored(_family_sets(docs, classes, ties, k), "family-sets")
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    rows = sets.select("family", "cid", block.alias("part"), F.lit(1).alias("role"), "members")
    large = sets.filter("blocks > 1")
    if large.isEmpty():
        return components(_confirmed(rows))
    heads = large.groupBy("family").agg(*_least(F.col("cid"), PIVOTS, "cid"))
    heads = heads.select("family", F.explode(F.array_distinct(F.array(*[F.col(f"p{s}.cid") for s in range(PIVOTS)]))).alias("cid"))
    heads = large.join(heads, ["family", "cid"]).select(
        "family", "cid", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(0).alias("role"), "members"
    )
    labels = components(_confirmed(rows.unionByName(heads)))
    own = large.join(labels, F.col("cid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cid")).drop("node")
    counts = own.groupBy("family", "label").agg(F.count("*").alias("n"), F.sum(F.length("members")).alias("size"))
    several = counts.groupBy("family").agg(
        F.max(F.struct("n", "label", "size")).alias("top"), F.sum("size").alias("size"), F.count("*").alias("labels")
    )
    several = several.filter("labels > 1").select(
        "family", F.col("top.label").alias("top"),
        F.ceil((F.col("size") - F.col("top.size")) / SET_BYTES).cast("int").alias("outside"),
    )
    roles = F.transform(
        F.sequence(F.lit(0), F.col("outside") - 1), lambda p: F.struct(p.alias("part"), F.lit(1).alias("role"))
    )
    mine = F.struct(F.pmod(F.xxhash64("cid", F.lit(1)), F.col("outside")).cast("int").alias("part"), F.lit(0).alias("role"))
    first = F.when(F.col("label") != F.col("top"), F.array(mine)).otherwise(F.array().cast("array<struct<part:int,role:int>>"))
    dealt = own.join(several, "family").select("family", "cid", "label", "members", F.inline(F.concat(first, roles)))
    dealt = dealt.repartition("family", "part").sortWithinPartitions("family", "part", "role")
    more = stored(dealt.mapInArrow(partial(_block_links, pct=SIMILARITY_PCT), LINKS).distinct(), "more-links")
    return labels if more.isEmpty() else joined_labels(labels, more)


def joined_labels(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Labels after further links between nodes: components of the labels themselves."""
    name_a, name_b = labels.toDF("a", "la"), labels.toDF("b", "lb")
    between = more.join(name_a, "a", "left").join(name_b, "b", "left").select(
        "a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")
    )
    between = stored(between, "between")
    merged = components(between.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
    merged = merged.toDF("old", "new")
    kept = labels.unionByName(
        between.select(F.col("la").alias("node"), F.col("la").alias("label"))
        .unionByName(between.select(F.col("lb").alias("node"), F.col("lb").alias("label")))
        .distinct()
        .join(labels, "node", "left_anti")
    )
    renamed = kept.join(merged, F.col("label") == F.col("old"), "left")
    return stored(renamed.select("node", F.coalesce("new", "label").alias("label")), "labels")


def near_classes(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, d1, d2, component_id) of every row; all else that was
    stored on the way is deleted."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash bigint, n_shingles bigint, d1 bigint, d2 bigint, tokens array<int>"
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))
    spark = docs.sparkSession
    with workspace(spark) as work:
        sketches = stored(rows.mapInArrow(partial(_sketch, k=k), schema), "sketches")
        classes = (
            sketches.filter(F.col("n_shingles") > 0)
            .groupBy("d1", "d2", "n_shingles")
            .agg(
                F.min("doc_id").alias("low"),
                F.min(F.struct("doc_id", "text_hash")).alias("one"),
                F.first("tokens").alias("tokens"),
            )
            .withColumn("cid", F.monotonically_increasing_id())
        )
        classes = stored(classes, "classes")
        with workspace(spark) as inner:
            ties = inner.outer.stored(families(classes), "families")
        with workspace(spark) as inner:
            labels = inner.outer.stored(confirmed_labels(docs, classes, ties, k), "components")
        named = classes.select("d1", "d2", "n_shingles", "low", "cid").join(labels, F.col("cid") == F.col("node"), "left")
        named = named.withColumn("label", F.coalesce("label", "cid"))
        lows = named.groupBy("label").agg(F.min("low").alias("component_id"))
        groups = named.join(lows, "label").select("d1", "d2", "n_shingles", "component_id")
        placed = sketches.drop("tokens").join(groups, ["d1", "d2", "n_shingles"], "left")
        return work.outer.stored(placed, "placed")


def near_duplicates(docs: DataFrame, words: int = 4) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept, one row per row of ``docs``.

    Ids may be of any type that has an order. Documents without words link with nothing and
    are their own component. A null id is never the smallest of a component that has another.
    Repeated rows get equal results. Columns other than doc_id and text are not read; an empty
    table gives an empty table.
    """
    placed = near_classes(docs, words)
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return placed.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"), "d1", "d2"
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _mark_bitmap(keys: DataFrame) -> DataFrame:
    """(__bucket, __bits) of the column ``__key``: one bit a key, of MARK_BUCKETS x 32,768."""
    return keys.groupBy(_mark_bucket(F.col("__key")).alias("__bucket")).agg(
        F.bitmap_construct_agg(_mark_bit(F.col("__key"))).alias("__bits")
    )


def _mark_bucket(key: Column) -> Column:
    return F.pmod(key, F.lit(MARK_BUCKETS)).cast("int")


def _mark_bit(key: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(key, 40), F.lit(BITMAP_BITS))


def _marked() -> Column:
    """Whether the bit of ``__at`` is set in ``__bits``."""
    bit = _mark_bit(F.col("__at"))
    byte = F.conv(F.hex(F.substring("__bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("getbit", byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))


def kept_documents(docs: DataFrame, words: int = 4) -> DataFrame:
    """One document of each component, with its columns; of repeated rows one.

    A bitmap of the rows that go, of MARK_BUCKETS x 4 kB at most, lets all others through where
    they are. Only texts whose bit is set move, to meet those rows by key, id and hash; of
    repeated ids, if there are any, once more.
    """
    marks = near_duplicates(docs, words).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "kept"
    )
    marks = marks.groupBy("__id", "__hash").agg(F.bool_and("kept").alias("__kept"), F.count("*").alias("__n"))
    odd = marks.filter("NOT __kept OR __n > 1").withColumn("__key", F.xxhash64("__id", "__hash"))
    odd = stored(odd, "dropped")
    bitmap = F.broadcast(stored(_mark_bitmap(odd), "bitmap"))
    rows = docs.withColumn("__own", F.xxhash64(text_or_empty()))
    rows = rows.withColumn("__at", F.xxhash64("doc_id", "__own"))
    rows = rows.join(bitmap, _mark_bucket(F.col("__at")) == F.col("__bucket"), "left")
    rows = rows.withColumn("__met", _marked()).drop("__bucket", "__bits")
    same = (F.col("__at") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash"))
    met = rows.filter("__met")
    kept = rows.filter("NOT __met").select(*docs.columns).unionByName(
        met.join(odd, same, "left_anti").select(*docs.columns)
    )
    again = odd.filter("__kept")
    if again.isEmpty():
        return kept
    once = met.join(again, same).dropDuplicates(["doc_id", "__own"]).select(*docs.columns)
    return kept.unionByName(once)


def near_table(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
