"""Benchmark decontamination by edit distance over item-sized windows.

Texts are sequences of lower-cased words. A window of as many words as an item holds is
embedded by a CGK random walk, which maps edit distance to Hamming distance: each step of the
walk puts out the current word and moves on or stays, as a random function of step and word
says, so two walks fall into step again soon after an edit. Bit-sampling keys over the
embedding, repeated over several walks, let windows meet the items near them in an equi-join;
every candidate is then verified by its exact edit distance. Many deletions leave two long
walks out of step for good, so there are more walks for longer items, and most of them sample
first steps only: an item at the limit is found with a probability of 0.99 at least.

Windows that cannot be near any item are left out before that, by bounds that lose nothing:
with at most d edits, all but d of an item's words and all but 2 d of its neighbouring pairs
are in the window, the pairs with the item's length besides. The words and pairs of all items
are a bitmap of fixed size, so what each task is sent does not grow with the benchmark; a
crowded bitmap only lets more through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.llm.common import stored, text_or_empty
from payrisk.llm.tokens import U64, Words, mixed, parts, random64, signed, words

MAX_EDIT_PCT = 20  # of an item's words
WALKS = 8  # and one more for every WORDS_PER_WALK words of an item
WORDS_PER_WALK = 32
FULL_WALKS = 4  # one walk in so many samples all steps, the others the first SHORT_STEPS
SHORT_STEPS = 128
SAMPLES = 8  # keys per walk
POSITIONS = 2  # sampled positions per key
BITMAP_BITS = 23  # 1 MB per bitmap

CHUNK = 4096  # windows embedded at a time, fewer if they are long
CHUNK_WORDS = 1 << 19

Bitmap = np.ndarray


def edits_allowed(n: int) -> int:
    return n * MAX_EDIT_PCT // 100


def walks_of(n: int) -> int:
    return WALKS + n // WORDS_PER_WALK


def chunk_of(n: int) -> int:
    return max(1, min(CHUNK, CHUNK_WORDS // n))


@lru_cache(maxsize=1 << 13)
def _sampled(n: int, walk: int) -> np.ndarray:
    """The steps whose words make the keys of one walk over n words: (SAMPLES, POSITIONS).

    A walk moves on at every other step, so it is past the end after about 2 n steps.
    """
    steps = max(1, 2 * n - n // 4)
    if walk % FULL_WALKS:
        steps = min(steps, SHORT_STEPS)
    return np.random.default_rng([n, walk]).integers(0, steps, (SAMPLES, POSITIONS))


@lru_cache(maxsize=256)
def _coins(walk: int, steps: int) -> np.ndarray:
    return random64(1 << (steps - 1).bit_length(), 100 + walk) | U64(1)


def keys_of(windows: np.ndarray) -> np.ndarray:
    """Bit-sampling keys of equally long windows, (rows, walks * SAMPLES)."""
    rows, n = windows.shape
    padded = np.concatenate([windows, np.zeros((rows, 1), dtype=U64)], axis=1)
    out = np.empty((rows, walks_of(n) * SAMPLES), dtype=U64)
    everyone = np.arange(rows)
    for walk in range(walks_of(n)):
        steps = _sampled(n, walk)
        last = int(steps.max()) + 1
        coins, embedded = _coins(walk, last), np.empty((last, rows), dtype=U64)
        at = np.zeros(rows, dtype=np.int64)
        for j in range(last):
            word = padded[everyone, at]
            embedded[j] = word
            at += (mixed(word ^ coins[j]) & U64(1)).astype(np.int64)
            np.minimum(at, n, out=at)
        for s in range(SAMPLES):
            key = np.full(rows, (n << 32) + (walk << 8) + s, dtype=U64)
            for p in range(POSITIONS):
                key = mixed(key * coins[0] + embedded[steps[s, p]])
            out[:, walk * SAMPLES + s] = key
    return out


def in_bitmap(bitmap: Bitmap, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> U64(64 - BITMAP_BITS)
    return (bitmap[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(hashes: DataFrame, column: str) -> Bitmap:
    """Bitmap over the top bits of 64-bit hashes, at most 2^(BITMAP_BITS - 6) rows of bits."""
    place = F.shiftrightunsigned(column, 64 - BITMAP_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))
    rows = hashes.groupBy(F.shiftright(place, 6).alias("slot")).agg(F.bit_or(bit).alias("bits"))
    bits = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    for slot, value in rows.collect():
        bits[slot] = value
    return bits.view(np.uint8)


def pairs_of(found: Words) -> np.ndarray:
    """A hash per word and the word behind it; the last word of a row is paired with none."""
    pairs = found.hashes.copy()
    pairs[:-1] = mixed(found.hashes[:-1] * U64(3) + found.hashes[1:])
    counts = found.counts()
    pairs[found.first[1:][counts > 0] - 1] = 0
    return pairs


def with_length(pairs: np.ndarray, n: int) -> np.ndarray:
    return mixed(pairs + U64(n * 0x9E3779B1))


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch.column("text")):
            found = words(part)
            ids = batch.column("item_id").slice(part.first, part.last - part.first)
            lists = [found.hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
            pairs = pairs_of(found)
            known = [
                np.concatenate([x, pairs[a : b - 1], with_length(pairs[a : b - 1], b - a)])
                for x, a, b in zip(lists, found.first[:-1], found.first[1:], strict=True)
            ]
            keys = [signed(keys_of(x[None, :])[0]) if len(x) else [] for x in lists]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(x) for x in lists], pa.int64()),
                    pa.array([x.tobytes() for x in lists], pa.binary()),
                    pa.array([signed(x) for x in known], pa.list_(pa.int64())),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["item_id", "n", "item_words", "vocabulary", "keys"],
            )


def item_table(benchmark: DataFrame) -> DataFrame:
    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = benchmark.select("item_id", F.lower(text_or_empty()).alias("text")).mapInArrow(
        _items,
        f"item_id {kind}, n bigint, item_words binary, vocabulary array<bigint>, keys array<bigint>",
    )
    return stored(rows.filter("n > 0"), "items")


def _running(flags: np.ndarray, more: int) -> np.ndarray:
    """Flags before each place, with ``more`` places behind the last."""
    upto = np.zeros(len(flags) + 1 + more, dtype=np.int32)
    np.cumsum(flags, dtype=np.int32, out=upto[1 : len(flags) + 1])
    upto[len(flags) + 1 :] = upto[len(flags)]
    return upto


@dataclass
class Scan:
    """The words and pairs of a part, counted as far as the items' bitmap knows them."""

    found: Words
    pairs: np.ndarray
    words_upto: np.ndarray
    pairs_upto: np.ndarray
    bitmap: Bitmap

    @classmethod
    def of(cls, found: Words, bitmap: Bitmap, longest: int) -> Scan:
        pairs = pairs_of(found)
        known = in_bitmap(bitmap, pairs) & (pairs != 0)
        return cls(
            found,
            np.concatenate([pairs, np.zeros(longest, dtype=U64)]),
            _running(in_bitmap(bitmap, found.hashes), longest),
            _running(known, longest),
            bitmap,
        )

    def windows(self, n: int) -> np.ndarray:
        """Starts of n-word windows with few enough unknown words and pairs.

        A window may lack words at the end of its text, as many as there are edits.
        """
        first, total, allowed = self.found.first, len(self.found.hashes), edits_allowed(n)
        least_pairs = n - 1 - 2 * allowed
        enough = self.words_upto[n : n + total] - self.words_upto[:total] >= n - allowed
        enough &= self.pairs_upto[n - 1 : n - 1 + total] - self.pairs_upto[:total] >= least_pairs
        starts = np.flatnonzero(enough)
        ends = np.minimum(starts + n, first[np.searchsorted(first, starts, side="right")])
        starts = starts[self.words_upto[ends] - self.words_upto[starts] >= n - allowed]
        near = [
            chunk[self._pairs_of_length(chunk, n) >= least_pairs]
            for chunk in np.array_split(starts, len(starts) // 8192 + 1)
        ]
        return np.concatenate(near)

    def _pairs_of_length(self, starts: np.ndarray, n: int) -> np.ndarray:
        pairs = self.pairs[starts[:, None] + np.arange(n - 1)]
        return (in_bitmap(self.bitmap, with_length(pairs, n)) & (pairs != 0)).sum(axis=1)


WINDOWS = (
    "wid bigint, doc_id {kind}, text_hash bigint, n bigint, start bigint, region binary, "
    "keys array<bigint>"
)


def _windows(
    batches: Iterator[pa.RecordBatch], lengths: list[int], vocabulary: Bitmap, item_keys: Bitmap
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        waiting: dict[int, list[tuple]] = {n: [] for n in lengths}
        for part in parts(batch.column("text")):
            found = words(part)
            scan = Scan.of(found, vocabulary, max(lengths, default=0))
            for n in lengths:
                starts, chunk = scan.windows(n), chunk_of(n)
                for begin in range(0, len(starts), chunk):
                    waiting[n].append(_cut_out(found, starts[begin : begin + chunk], n, part.first))
                    if sum(len(x[0]) for x in waiting[n]) >= chunk:
                        yield from _keyed(batch, waiting[n], n, item_keys)
                        waiting[n] = []
        for n in lengths:
            if waiting[n]:
                yield from _keyed(batch, waiting[n], n, item_keys)


def _cut_out(found: Words, starts: np.ndarray, n: int, first_row: int) -> tuple:
    """(words of the windows, rows of the batch, places in the text, regions around)."""
    row = np.searchsorted(found.first, starts, side="right") - 1
    low, high = found.first[row], found.first[row + 1]
    inside = starts[:, None] + np.arange(n)
    filled = np.concatenate([found.hashes, np.zeros(n, dtype=U64)])
    around = 2 * edits_allowed(n)
    regions = [
        found.hashes[max(a, s - around) : min(b, s + n + around)].tobytes()
        for a, b, s in zip(low.tolist(), high.tolist(), starts.tolist(), strict=True)
    ]
    return np.where(inside < high[:, None], filled[inside], U64(0)), first_row + row, starts - low, regions


def _keyed(batch, cut: list[tuple], n: int, item_keys: Bitmap) -> Iterator[pa.RecordBatch]:
    """The windows with a key that some item may have, with those keys."""
    windows, rows, places = (np.concatenate([x[i] for x in cut]) for i in range(3))
    regions = [r for x in cut for r in x[3]]
    keys = keys_of(windows)
    hits = in_bitmap(item_keys, keys)
    chosen = np.flatnonzero(hits.any(axis=1))
    if not len(chosen):
        return
    doc_id, text_hash = (batch.column(c).take(pa.array(rows[chosen])) for c in ("doc_id", "text_hash"))
    place = places[chosen]
    own = np.asarray(batch.column("row_key").take(pa.array(rows[chosen]))).view(U64)
    wid = mixed(own + (place.astype(U64) << U64(16)) + U64(n))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(signed(wid)),
            doc_id,
            text_hash,
            pa.array(np.full(len(chosen), n, dtype=np.int64)),
            pa.array(place.astype(np.int64)),
            pa.array([regions[i] for i in chosen], pa.binary()),
            pa.array([signed(keys[i][hits[i]]) for i in chosen], pa.list_(pa.int64())),
        ],
        names=["wid", "doc_id", "text_hash", "n", "start", "region", "keys"],
    )


def word_places(item: list[int]) -> dict[int, int]:
    """The places of each word of the item, as bits."""
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    return places


def least_edits(places: dict[int, int], n: int, region: list[int]) -> int:
    """Fewest word edits between an item of n words and any run of words of the region.

    A column of the edit table is two bit vectors, of the rises and the falls from word to word
    of the item; each word of the region turns it into the next one. The table's first row is
    0, so a run may begin anywhere.
    """
    full, last = (1 << n) - 1, 1 << (n - 1)
    rises, falls, score, best = full, 0, n, n
    for w in region:
        same = places.get(w, 0)
        vertical = same | falls
        horizontal = (((same & rises) + rises) ^ rises) | same
        up = falls | (full & ~(horizontal | rises))
        down = rises & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
            best = min(best, score)
        up, down = up << 1 & full, down << 1 & full
        rises = down | (full & ~(vertical | up))
        falls = up & vertical
    return best


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, tuple[dict[int, int], int]] = {}
    for batch in batches:
        items, regions = batch.column("item_words"), batch.column("region")
        edits = np.zeros(batch.num_rows, dtype=np.int64)
        for i in range(batch.num_rows):
            item, region = items[i].as_py(), regions[i].as_py()
            if item in region:
                continue
            if item not in known:
                if len(known) == 4096:
                    known.clear()
                own = np.frombuffer(item, dtype=U64).tolist()
                known[item] = word_places(own), len(own)
            edits[i] = least_edits(*known[item], np.frombuffer(region, dtype=U64).tolist())
        kept = batch.select(["doc_id", "text_hash", "item_id", "n", "start"])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(edits)], names=[*kept.schema.names, "edits"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, n, start, edits): items found in documents.

    A hit is a run of words within ``MAX_EDIT_PCT`` of the item's words in edits. ``start`` is
    the word at which the best of the verified windows begins. Items and documents without
    words, null texts among them, are part of no hit; an empty table on either side gives
    none. Repeated rows give one hit; ids may be of any type. Only doc_id, text and item_id are
    read.
    """
    items = item_table(benchmark)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    lengths = sorted(r.n for r in items.select("n").distinct().collect())
    item_keys = items.select("item_id", F.explode("keys").alias("key")).distinct()
    vocabulary = bitmap_of(items.select(F.explode("vocabulary").alias("w")), "w")
    scan = partial(
        _windows, lengths=lengths, vocabulary=vocabulary, item_keys=bitmap_of(item_keys, "key")
    )
    own_hash = F.xxhash64(text_or_empty())
    texts = docs.select(
        "doc_id", own_hash.alias("text_hash"), F.xxhash64(F.col("doc_id").isNull(), "doc_id", own_hash).alias("row_key"),
        F.lower(text_or_empty()).alias("text"),
    )
    found = stored(texts.mapInArrow(scan, WINDOWS.format(kind=doc_kind)), "windows")
    pairs = (
        found.select("wid", F.explode("keys").alias("key"))
        .join(item_keys, "key")
        .select("wid", "item_id")
        .distinct()
        .join(found.select("wid", "doc_id", "text_hash", "n", "start"), "wid")
    )
    # A region reaches twice the edits beyond its window, so one window stands for all that
    # begin within the edits behind it.
    stretch = F.floor(F.col("start") / (1 + F.floor(F.col("n") * MAX_EDIT_PCT / 100)))
    candidates = (
        pairs.groupBy("doc_id", "text_hash", "item_id", stretch.alias("stretch"))
        .agg(F.min(F.struct("start", "wid")).alias("one"))
        .select("item_id", "one.wid")
        .join(found.drop("keys", "n").dropDuplicates(["wid"]), "wid")
        .join(items.select("item_id", "n", "item_words"), "item_id")
    )
    checked = candidates.select("doc_id", "text_hash", "item_id", "n", "start", "region", "item_words").mapInArrow(
        _verify, f"doc_id {doc_kind}, text_hash bigint, item_id {kind}, n bigint, start bigint, edits bigint"
    )
    near = checked.filter(F.col("edits") * 100 <= F.col("n") * MAX_EDIT_PCT)
    best = F.min(F.struct("edits", "start")).alias("best")
    return near.groupBy("doc_id", "text_hash", "item_id", "n").agg(best).select(
        "doc_id", "text_hash", "item_id", "n", "best.start", "best.edits"
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item was found, with their columns."""
    hits = stored(contaminated(docs, benchmark).select("doc_id", "text_hash").distinct(), "leaks")
    hits = hits.toDF("__id", "__hash")
    rows = docs.withColumn("__own", F.xxhash64(text_or_empty()))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash"))
    return rows.join(hits, same, "left_anti").select(*docs.columns)


def leak_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).select(
        "doc_id", "item_id", F.col("n").alias("item_words"), F.col("start").alias("start_word"), "edits"
    )
