"""Words of Arrow text columns as 64-bit hashes, whole batches at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 2 << 20
U64 = np.uint64
_MASK = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15 | 1  # odd, so powers of it have inverses


def random64(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, size=n, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value spread over all others."""
    v = values ^ (values >> U64(31))
    v *= U64(0x7FB5D329728EA185)
    v ^= v >> U64(27)
    v *= U64(0x81DADEF4BC2DD44D)
    v ^= v >> U64(33)
    return v


def _byte_values() -> np.ndarray:
    values = random64(256, 7)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


BYTE_VALUE = _byte_values()
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _STEP, dtype=U64)
    down = np.full(n, pow(_STEP, -1, 1 << 64), dtype=U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = PART_BYTES + 1
    while size < n:
        size *= 2
    return _powers(size)


@dataclass
class Part:
    """Rows ``first`` to ``last`` of a column: their bytes and the rows' offsets in them."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def parts(column: pa.Array, most: int = PART_BYTES) -> Iterator[Part]:
    """A text column in runs of rows of about ``most`` bytes; a longer text is one by itself."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield Part(row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


@dataclass
class Words:
    """Hashes of the words of a part; row r holds words ``first[r]`` to ``first[r + 1]``."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(part: Part) -> Words:
    """Lower-cased (A-Z) words of every row; words never reach over two rows."""
    data, offsets = part.data, part.offsets
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(U64), none, none, np.zeros(len(offsets), dtype=np.int64))
    inside = ~IS_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = powers(n)
    upto = np.empty(n + 1, dtype=U64)
    upto[0] = 0
    np.cumsum(BYTE_VALUE[data] * up[:n], out=upto[1:])
    hashes = mixed((upto[ends] - upto[starts]) * down[starts] + (ends - starts).astype(U64))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the k-word shingles by row, with repeats.

    A row with fewer words has its whole sequence as its one shingle; one without words none.
    """
    counts, h = found.counts(), found.hashes
    n = len(h)
    factor = U64(0xD1342543DE82EF95)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(first[-1], dtype=U64)
    if n >= k:
        joined = h[: n - k + 1].copy()
        for j in range(1, k):
            joined *= factor
            joined += h[j : n - k + 1 + j]
        row = np.repeat(np.arange(len(counts)), counts)
        whole = np.arange(n) + k <= found.first[1:][row]
        whole = whole[: n - k + 1]
        target = first[row[: n - k + 1]] + np.arange(n - k + 1) - found.first[row[: n - k + 1]]
        out[target[whole]] = joined[whole]
    for r in np.flatnonzero((counts > 0) & (counts < k)):
        value = len(h[found.first[r] : found.first[r + 1]])
        for w in h[found.first[r] : found.first[r + 1]].tolist():
            value = (value * int(factor) + w) & _MASK
        out[first[r]] = value
    return mixed(out), first


def distinct_by_row(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every row, and the rows' new bounds."""
    values = values.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        values[a:b].sort()
    new = np.ones(len(values), dtype=bool)
    if len(values):
        new[1:] = values[1:] != values[:-1]
        new[first[:-1][np.diff(first) > 0]] = True
    upto = np.concatenate([[0], np.cumsum(new)])
    return values[new], upto[first]


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
