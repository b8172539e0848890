"""Runs of periodic words, by an enhanced suffix array and the branching-tandem test.

The words of a batch of texts are numbered apart for each text, so that one suffix array over
the batch never mixes two texts. Sorting by doubled prefixes leaves a rank per level: the
first 2^k words at two places are equal if their ranks of level k are. LCP values follow from
the ranks, LCP intervals from the nearest smaller values on both sides; no tree is built.

A square of period d whose next word breaks the period joins two suffixes i and i + d that
part after d words: they lie in different children of an LCP interval of depth d. For every
interval all children but the largest are searched, asking the inverse suffix array whether
i + d and i - d lie in another child; a suffix is asked for log n times at most. Each square
found is rotated to the left as far as its period holds, whole powers of two at a time, and
squares of the same stretch are merged into the run of the smallest period.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.llm.common import text_or_empty
from payrisk.llm.tokens import parts

# What counts as a run.
LEAST_LENGTH = 6
LEAST_EXPONENT = 4
EXPANDED = 1 << 20  # suffixes that are searched at a time

RESULT = (
    "n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)


@dataclass
class SuffixArray:
    """Slots in suffix order, their inverse, LCP with the slot before, ranks by level."""

    order: np.ndarray
    slot: np.ndarray
    lcp: np.ndarray
    levels: list[np.ndarray]


def suffix_array(codes: np.ndarray) -> SuffixArray:
    """Prefix doubling; only suffixes that still share their rank are sorted again."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = codes[order[1:]] != codes[order[:-1]]
    places = np.arange(n)
    rank = np.full(n + 1, -1, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, places, 0))
    levels = [rank]
    parted = np.where(fresh, 0, -1)  # level at which a slot differs from the one before
    again = ~fresh
    again[:-1] |= ~fresh[1:]
    active = np.flatnonzero(again)
    width = 1
    while len(active):
        p = order[active]
        key = rank[p] * (n + 1) + rank[p + width] + 1
        by_key = np.argsort(key, kind="stable")
        p, key = p[by_key], key[by_key]
        order[active] = p
        fresh = np.ones(len(p), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        rank = rank.copy()
        rank[p] = active[np.maximum.accumulate(np.where(fresh, np.arange(len(p)), 0))]
        levels.append(rank)
        new = active[fresh]
        parted[new[parted[new] < 0]] = len(levels) - 1
        again = ~fresh
        again[:-1] |= ~fresh[1:]
        active = active[again]
        width *= 2
    slot = np.full(n + 1, -1, dtype=np.int64)
    slot[order] = places
    return SuffixArray(order, slot, _lcp(order, parted, levels), levels)


def _lcp(order: np.ndarray, parted: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each slot shares with the one before; 0 at both ends."""
    lcp = np.zeros(len(order) + 1, dtype=np.int64)
    some = parted > 0
    lcp[:-1][some] = 1 << (parted[some] - 1)
    for k in range(len(levels) - 3, -1, -1):
        at = np.flatnonzero(parted >= k + 2)
        shared = lcp[at]
        equal = levels[k][order[at - 1] + shared] == levels[k][order[at] + shared]
        lcp[at] = shared + (equal.astype(np.int64) << k)
    return lcp


def _nearest_smaller(lcp: np.ndarray, step: int) -> np.ndarray:
    """For each slot with an LCP, the nearest one before (-1) or behind (1) with a smaller LCP."""
    near = np.arange(len(lcp)) + step
    active = np.flatnonzero(lcp > 0)
    while len(active):
        far = near[active]
        higher = lcp[far] >= lcp[active]
        active, far = active[higher], far[higher]
        near[active] = near[far]
    return near


def branching_squares(found: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares that the next word does not go on with."""
    lcp, order, slot = found.lcp, found.order, found.slot
    at = np.flatnonzero(lcp > 0)
    none = np.zeros(0, dtype=np.int64)
    if not len(at):
        return none, none
    low, high = _nearest_smaller(lcp, -1)[at], _nearest_smaller(lcp, 1)[at]
    sort = np.argsort(low * len(lcp) + high, kind="stable")
    at, low, high = at[sort], low[sort], high[sort]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    group = np.cumsum(first) - 1
    opens = np.flatnonzero(first)
    closes = np.append(opens[1:], len(at))
    # Children of an interval lie between the slots of its depth.
    child_low = np.empty(len(at) + len(opens), dtype=np.int64)
    child_high, owner = np.empty_like(child_low), np.empty_like(child_low)
    inner, last = np.arange(len(at)) + group, closes + np.arange(len(opens))
    child_low[inner] = np.where(first, low, np.concatenate([[0], at[:-1]]))
    child_high[inner] = at
    child_low[last], child_high[last] = at[closes - 1], high[opens]
    owner[inner], owner[last] = group, np.arange(len(opens))
    size = child_high - child_low
    begins = opens + np.arange(len(opens))
    largest = size == np.maximum.reduceat(size, begins)[owner]
    keep = np.where(largest, np.arange(len(size)), len(size))
    small = np.ones(len(size), dtype=bool)
    small[np.minimum.reduceat(keep, begins)] = False
    small = np.flatnonzero(small)
    depth, low, high = lcp[at[opens]], low[opens], high[opens]
    starts, periods = [none], [none]
    upto = np.cumsum(size[small])
    cuts = np.searchsorted(upto, np.arange(EXPANDED, upto[-1] + EXPANDED, EXPANDED), side="left") + 1
    for a, b in zip(np.append(0, cuts[:-1]).tolist(), cuts.tolist(), strict=True):
        children = small[a:b]
        if not len(children):
            continue
        child = np.repeat(children, size[children])
        inside = np.arange(len(child)) - np.repeat(np.cumsum(size[children]) - size[children], size[children])
        p = order[child_low[child] + inside]
        g = owner[child]
        d = depth[g]
        for other, begin in ((p + d, p), (p - d, p - d)):
            s = np.where(other >= 0, slot[np.maximum(other, 0)], -1)
            hit = (s >= low[g]) & (s < high[g]) & ((s < child_low[child]) | (s >= child_high[child]))
            starts.append(begin[hit])
            periods.append(d[hit])
    return np.concatenate(starts), np.concatenate(periods)


def runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all maximal runs of two periods or more, by start and period."""
    none = np.zeros(0, dtype=np.int64)
    if len(codes) < 2:
        return none, none, none
    found = suffix_array(codes)
    start, period = branching_squares(found)
    end = start + 2 * period
    for k in range(len(found.levels) - 1, -1, -1):
        back = start - (1 << k)
        inside = np.maximum(back, 0)
        equal = (back >= 0) & (found.levels[k][inside] == found.levels[k][inside + period])
        start = np.where(equal, back, start)
    by_stretch = np.lexsort((period, end, start))
    start, end, period = start[by_stretch], end[by_stretch], period[by_stretch]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def planted_places(n: int, h: int) -> np.ndarray | None:
    """Which original word stands at each place of a text that is made periodic; None: not made."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places >= a, a + (places - a) % p, places)


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _row(words: list[bytes], places: np.ndarray | None, start, end, period) -> tuple:
    """One text's result from its words and runs."""
    n = len(words)
    stays = None
    if len(start):
        edge = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, end, -1)
        stays = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    if places is not None:
        stays = places if stays is None else places[stays]
    kept = words if stays is None else [words[i] for i in stays.tolist()]
    length = end - start
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    best = (None, None, None, None)
    if len(start):
        s, m, q = min(zip(start.tolist(), length.tolist(), period.tolist(), strict=True), key=lambda r: (-r[1], r[0], r[2]))
        best = (s, m, q, 1000 * m // q)
    return (n, len(start), *best, _digest(listed.encode()), _digest(b" ".join(kept)))


def _find(batches: Iterator[pa.RecordBatch], key: str, planted: bool) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in RESULT.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    for batch in batches:
        for part in parts(batch.column("text")):
            texts, codes, first = [], [], [0]
            hashes = batch.column("h")[part.first : part.last].to_pylist()
            base = 0
            for row in range(part.last - part.first):
                words = part.text(row).split()
                number = dict.fromkeys(words)
                for i, w in enumerate(number, base):
                    number[w] = i
                base += len(number)
                own = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
                places = planted_places(len(words), hashes[row]) if planted else None
                codes.append(own if places is None else own[places])
                texts.append((words, places))
                first.append(first[-1] + len(words))
            start, end, period = runs(np.concatenate(codes))
            enough = end - start >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
            start, end, period = start[enough], end[enough], period[enough]
            at = np.searchsorted(start, first)
            rows = []
            for row, (words, places) in enumerate(texts):
                own = slice(at[row], at[row + 1])
                rows.append(_row(words, places, start[own] - first[row], end[own] - first[row], period[own]))
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            ids = batch.column(key).slice(part.first, part.last - part.first)
            yield pa.RecordBatch.from_arrays([ids, *columns], names=[key, *names])


def key_hash(key: str = "doc_id") -> Column:
    """crc32 of the key as text; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """doc_id and the columns of ``RESULT``, one row per row of ``docs``.

    A run is a stretch of words with smallest period q, at least ``LEAST_LENGTH`` words and
    ``LEAST_EXPONENT`` periods long, that no neighbouring word goes on with. start to
    exponent_milli are of the longest one (ties: smallest start, then period), null without
    runs. runs_sha256 is over all runs, collapsed_sha256 over the words left when all but the
    first period of every run is dropped. ``planted`` first makes a tenth of the texts, chosen
    by their id's hash, periodic from some word on.

    Null and empty texts have no words and no runs. Repeated rows get equal results; an empty
    table gives an empty table; columns other than doc_id and text are not read. A text is
    handled whole: about 300 bytes of memory a word, and 8 more for each doubling of its
    longest repeat.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", key_hash().alias("h"), text_or_empty().alias("text"))
    return rows.mapInArrow(partial(_find, key="doc_id", planted=planted), f"doc_id {kind}, {RESULT}")


def runs_table(docs: DataFrame) -> DataFrame:
    return periodic_runs(docs, planted=True).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )
