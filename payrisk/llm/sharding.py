"""Shards of near-equal bytes: the minimax contiguous partition over groups of equal texts.

Groups lie in the order of their text's hash. The smallest feasible shard capacity is found
by binary search with a greedy check, and the shards are cut there. The search works on sums
of hash ranges; ranges in which a cut can fall are divided until every cut lies between two
groups, so the capacity is the exact optimum over the groups, whatever their number. The
driver sees range sums only, never groups beyond the few ranges around the cuts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.llm.common import stored, text_or_empty

SHARDS = 16
FIRST_BITS = 14  # 16,384 ranges at first
MORE_BITS = 8
LARGE_PART = 128  # a range above this part of a shard is divided before all others
CELLS = 4096


@dataclass(frozen=True)
class Unit:
    """A range of text hashes: first and last hash in it, bytes, number of groups."""

    first: int
    last: int
    size: int
    groups: int


def text_hash() -> Column:
    return F.xxhash64(text_or_empty())


def row_size() -> Column:
    return (F.octet_length(text_or_empty()) + 1).cast("bigint")


class Line:
    """Units in order with their running sums: what the capacity search asks about."""

    def __init__(self, units: list[Unit]):
        self.units = units
        self.upto = [0, *accumulate(u.size for u in units)]
        self.total = self.upto[-1]

    def reach(self, start: int, capacity: float) -> int:
        """Index after the last unit that fits behind ``start``."""
        return bisect_right(self.upto, self.upto[start] + capacity) - 1

    def greedy(self, capacity: float, shards: int, start: int = 0) -> list[int]:
        ends = []
        for _ in range(shards):
            start = self.reach(start, capacity)
            ends.append(start)
        return ends

    def fits(self, capacity: float, shards: int, start: int = 0) -> bool:
        ends = self.greedy(capacity, shards, start)
        return (ends[-1] if ends else start) == len(self.units)

    def capacity(self, shards: int) -> int:
        """Smallest capacity with which the greedy cut needs at most ``shards`` shards."""
        low = max([-(-self.total // shards), *(u.size for u in self.units)])
        high = max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.fits(middle, shards) else (middle + 1, high)
        return low

    def cuts(self, capacity: int, shards: int) -> list[int]:
        """Ends of the shards, none above the capacity, each as near as possible to an even
        part of what is left, so that one huge group does not leave other shards empty."""
        ends, start = [], 0
        for left in range(shards, 0, -1):
            most = self.reach(start, capacity)
            even = self.upto[start] + (self.total - self.upto[start]) / left
            above = min(bisect_left(self.upto, even), len(self.units))
            near = sorted((above - 1, above), key=lambda k: abs(self.upto[k] - even))
            fitting = [k for k in near if start <= k <= most and self.fits(capacity, left - 1, k)]
            start = fitting[0] if fitting else most
            ends.append(start)
        return ends


def _summed(groups: DataFrame, bits: int) -> list[Unit]:
    ranges = groups.groupBy(F.shiftright("hash", 64 - bits).alias("range")).agg(
        F.min("hash"), F.max("hash"), F.sum("size"), F.count("*")
    )
    return [Unit(*row[1:]) for row in ranges.collect()]


def _to_divide(line: Line, capacity: int, shards: int) -> list[tuple[int, int]]:
    """Runs of units, as (start, end), in which a cut of the best partition may fall.

    Moving each cut to the end of its unit adds at most one unit to a shard, so the best
    capacity is no more than one unit below. Greedy cuts grow with the capacity, which bounds
    each from both sides. Units far larger than others are divided first: they hold a hot
    group, which must not widen those bounds.
    """
    several = [i for i, u in enumerate(line.units) if u.groups > 1]
    if not several:
        return []
    largest = sorted(several, key=lambda i: -line.units[i].size)[:shards]
    large = sorted(i for i in largest if line.units[i].size * shards * LARGE_PART > line.total)
    if large:
        return [(i, i + 1) for i in large]
    widest = line.units[largest[0]].size
    low = line.greedy(max(capacity - widest, -(-line.total // shards)), shards)
    high = line.greedy(capacity + widest, shards)
    runs: list[tuple[int, int]] = []
    for a, b in zip(low, high, strict=True):
        start, end = max(a - 1, 0), min(b + 1, len(line.units))
        if runs and start <= runs[-1][1]:
            start, end = runs.pop()[0], max(end, start)
        runs.append((start, end))
    return [r for r in runs if any(line.units[i].groups > 1 for i in range(*r))]


def best_cuts(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[int | None]]:
    """(capacity, last hash of each shard but the last) for groups of (hash, size)."""
    bits = FIRST_BITS
    units = _summed(groups, bits)
    while True:
        line = Line(sorted(units, key=lambda u: u.first))
        capacity = line.capacity(shards)
        divide = _to_divide(line, capacity, shards)
        if not divide:
            break
        bits = min(64, bits + MORE_BITS)
        inside = reduce(
            lambda a, b: a | b,
            [
                F.col("hash").between(line.units[a].first, line.units[b - 1].last)
                for a, b in divide
            ],
        )
        gone = {i for a, b in divide for i in range(a, b)}
        units = [u for i, u in enumerate(line.units) if i not in gone]
        units += _summed(groups.filter(inside), bits)
    ends = line.cuts(capacity, shards)
    return capacity, [line.units[e - 1].last if e else None for e in ends[:-1]]


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All rows and columns of ``docs`` plus ``shard``, 0 to ``shards`` - 1.

    Equal texts share a shard; null and empty texts count as equal. A map over the documents
    once the cuts are known: texts are never shuffled. An empty table gives an empty table;
    a column named ``shard`` is replaced.
    """
    sizes = docs.select(text_hash().alias("hash"), row_size().alias("size"))
    groups = stored(sizes.groupBy("hash").agg(F.sum("size").alias("size")), "shard-groups")
    _, ends = best_cuts(groups, shards)
    shard = F.lit(0)
    for last in ends:
        shard = shard + (F.lit(True) if last is None else text_hash() > F.lit(last)).cast("int")
    return docs.withColumn("shard", shard)


def with_slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Add ``slot``: places 0, 1, ... without gaps in each shard.

    Rows fall into cells by the hash of their ``order`` columns, which spreads hot groups too;
    a cell's first place is the number of rows in the cells before it. The table of cells has
    at most shards x 4096 rows, so it may be broadcast.
    """
    celled = rows.withColumn("__cell", F.pmod(F.xxhash64(*order), F.lit(CELLS)))
    counts = celled.groupBy(shard, "__cell").agg(F.count("*").alias("__n"))
    running = Window.partitionBy(shard).orderBy("__cell")
    first = counts.select(
        shard, "__cell", (F.sum("__n").over(running) - F.col("__n")).alias("__first")
    )
    place = F.row_number().over(Window.partitionBy(shard, "__cell").orderBy(*order))
    return (
        celled.withColumn("__place", place)
        .join(F.broadcast(first), [shard, "__cell"])
        .withColumn("slot", F.col("__first") + F.col("__place") - 1)
        .drop("__cell", "__first", "__place")
    )


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: its size, checksum, shard and place in it.

    A null text has size 1 and the checksum of the empty text.
    """
    rows = assign_shards(docs, shards).select(
        "doc_id",
        row_size().alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
    )
    placed = with_slots(rows, "shard", ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
