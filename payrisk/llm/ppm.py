"""Language-model scoring by prediction by partial matching, beside a word model.

The model is a byte-context trie of ``ORDER`` levels with the counts of all training texts. A
byte is predicted from its longest known context; if it was never seen there, an escape
(method C: as likely as there are different bytes in the context) leads to the next shorter
one, in which the bytes of the longer context are excluded. Below order 0 all bytes that are
left are equally likely. The byte 255, which UTF-8 never uses, ends a text.

Nothing of the model's size is held in one place. Documents form blocks of some megabytes. A
block's contexts and words, counted, are dealt out to buckets by context or word. A bucket
adds up the counts of all blocks and works out the log-probability of every (context, byte)
asked for; with symbol exclusion that depends on the context alone. The answers return to
their blocks, where the documents are scored. Only the counts of byte pairs, 65,536 at most,
are known to all buckets.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk.llm.common import crc_part, stored, text_or_empty
from payrisk.llm.tokens import U64, mixed, parts, signed, words

HELD_OUT = (5, 1)  # crc32 of the id modulo 5 is 1
ORDER = 5  # bytes of context; with the byte itself a key has 48 bits
BLOCK_BYTES = 8 << 20
END = 255
SHIFT = 8 * ORDER
WORD_KEY = np.int64(1) << np.int64(62)  # marks a key as a word's hash


def held_out() -> Column:
    return crc_part(HELD_OUT[0]) == HELD_OUT[1]


def packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, which compress to a fraction."""
    return packed(np.diff(keys, prepend=np.int64(0)))


def unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype=kind)


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.int64))


def context_keys(part) -> tuple[np.ndarray, np.ndarray]:
    """(keys, first): one key per byte of every row and one for its end.

    A key holds the contexts from the nearest byte down, so that every shorter context is a
    prefix of it, then the predicted byte. Before a text stand ends of text.
    """
    sizes = np.diff(part.offsets)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    stream = np.full(len(part.data) + ORDER * (len(sizes) + 1), END, dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    stream[np.arange(len(part.data)) + ORDER * (row + 1)] = part.data
    row = np.repeat(np.arange(len(sizes)), sizes + 1)
    at = np.arange(first[-1]) + ORDER + (ORDER - 1) * row
    keys = stream[at]
    for k in range(1, ORDER + 1):
        keys |= stream[at - k] << np.int64(SHIFT - 8 * (k - 1))
    return keys, first


def word_keys(found) -> np.ndarray:
    """Hashes of 62 bits of the words, apart from all context keys."""
    return signed(found.hashes >> U64(2)) | WORD_KEY


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sums of their counts."""
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.diff(keys, prepend=np.int64(-1)))
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _counted(keys: np.ndarray, weight: int) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.unique(keys, return_counts=True)
    return keys, counts * weight


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Contexts by their nearest two bytes, words by their hash."""
    near = np.where(keys & WORD_KEY, keys, keys >> np.int64(SHIFT - 8))
    return (mixed(near.view(U64)) % U64(buckets)).astype(np.int64)


COUNTS = "bucket bigint, block bigint, keys binary, counts binary"


def block_keys(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted contexts and words of a block with their counts; held-out rows count 0."""
    keys, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for batch in rows.to_batches():
        held = np.asarray(batch.column("held_out"))
        for part in parts(batch.column("text")):
            own = held[part.first : part.last]
            contexts, first = context_keys(part)
            found = words(part)
            for values, sizes in ((contexts, np.diff(first)), (word_keys(found), found.counts())):
                asked = np.repeat(own, sizes)
                for weight, chosen in ((1, values[~asked]), (0, values[asked])):
                    k, n = _counted(chosen, weight)
                    keys.append(k)
                    counts.append(n)
    return summed(keys, counts)


def dealt(keys: np.ndarray, buckets: int) -> dict[int, np.ndarray]:
    """Positions of a block's keys by bucket, in the order of the keys."""
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return {b: order[bounds[b] : bounds[b + 1]] for b in range(buckets) if bounds[b + 1] > bounds[b]}


def _count_block(key: tuple, rows: pa.Table, buckets: int) -> pa.Table:
    """The contexts and words of one block by bucket."""
    keys, counts = block_keys(rows)
    places = dealt(keys, buckets)
    return pa.table(
        {
            "bucket": pa.array(list(places), pa.int64()),
            "block": pa.array([key[0].as_py()] * len(places), pa.int64()),
            "keys": pa.array([packed_keys(keys[i]) for i in places.values()], pa.binary()),
            "counts": pa.array([packed(counts[i]) for i in places.values()], pa.binary()),
        }
    )


def _byte_pairs(batches):
    """(context byte, byte) -> count over the training texts, summed per task."""
    total: Counter = Counter()
    for batch in batches:
        for data, numbers in zip(batch.column("keys"), batch.column("counts"), strict=True):
            keys, counts = unpacked_keys(data.as_py()), unpacked(numbers.as_py(), np.int64)
            keep = (keys & WORD_KEY == 0) & (counts > 0)
            pair = (keys[keep] >> np.int64(SHIFT)) * 256 + (keys[keep] & 255)
            sums = np.bincount(pair, weights=counts[keep])
            at = np.flatnonzero(sums)
            total.update(dict(zip(at.tolist(), sums[at].astype(np.int64).tolist(), strict=True)))
    yield pa.RecordBatch.from_pydict({"pair": list(total), "n": list(total.values())}, schema=pa.schema([("pair", pa.int64()), ("n", pa.int64())]))


def _grouped(pairs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(np.diff(pairs, prepend=np.int64(-1)))
    return pairs[at], np.add.reduceat(values, at) if len(at) else values


def _lookup(names: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values by sorted name, 0 where there is none."""
    if not len(names):
        return np.zeros(len(wanted), dtype=np.float64)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return np.where(names[at] == wanted, values[at], 0).astype(np.float64)


def context_logs(keys: np.ndarray, counts: np.ndarray, near: np.ndarray) -> np.ndarray:
    """log10 of the probability of every context key.

    ``near`` has the counts of byte pairs (context byte, byte). All keys of a two-byte context
    are here, so longer contexts are counted from the keys themselves.
    """
    symbol = keys & np.int64(255)
    trained = counts > 0
    least = near.sum(axis=0).astype(np.float64)
    logs, done = np.zeros(len(keys)), np.zeros(len(keys), dtype=bool)
    # per order: sorted (context, byte) pairs with counts
    known = {}
    for k in range(2, ORDER + 1):
        pair = (keys[trained] >> np.int64(8 * (ORDER + 1 - k)) << np.int64(8)) | symbol[trained]
        order = np.argsort(pair, kind="stable")
        known[k] = _grouped(pair[order], counts[trained][order].astype(np.float64))

    def count_of(k: int, pair: np.ndarray) -> np.ndarray:
        """Counts at order k of pairs whose context has k bytes."""
        if k >= 2:
            return _lookup(*known[k], pair)
        if k == 1:
            return near[pair >> 8, pair & 255].astype(np.float64)
        return least[pair & 255]

    excluded, left_out = np.zeros(len(keys)), np.zeros(len(keys))
    for k in range(ORDER, -1, -1):
        context = keys >> np.int64(8 * (ORDER + 1 - k))
        if k >= 2:
            pairs, n = known[k]
            owner = pairs >> np.int64(8)
            shorter = (owner >> np.int64(8) << np.int64(8)) | (pairs & np.int64(255))
            names, total = _grouped(owner, n)
            kinds = _grouped(owner, np.ones(len(n)))[1]
            below = _grouped(owner, count_of(k - 1, shorter))[1]
            total, kinds, below = (_lookup(names, v, context) for v in (total, kinds, below))
        elif k == 1:
            some = near > 0
            total = near.sum(axis=1)[context].astype(np.float64)
            kinds = some.sum(axis=1)[context].astype(np.float64)
            below = (some * least).sum(axis=1)[context]
        else:
            total, kinds = np.full(len(keys), least.sum()), np.full(len(keys), float((least > 0).sum()))
            below = np.zeros(len(keys))
        count = count_of(k, (context << np.int64(8)) | symbol)
        mass, kind = total - excluded, kinds - left_out
        whole = mass + kind
        with np.errstate(divide="ignore", invalid="ignore"):
            here = np.where(count > 0, count, kind) / whole
        use = ~done & (whole > 0)
        logs[use] += np.log10(here[use])
        done |= use & (count > 0)
        excluded, left_out = below, kinds
    logs[~done] -= np.log10(256 - (least > 0).sum())
    return logs


VALUES = "block bigint, bucket bigint, logs binary, seen binary, tokens bigint, kinds bigint"


def _answer_bucket(key: tuple, rows: pa.Table, near: np.ndarray) -> pa.Table:
    """Adds up a bucket's counts and answers every block, in the order of its keys: the
    log-probabilities of its contexts, then the counts of its words."""
    blocks = rows.column("block").to_pylist()
    asked = [unpacked_keys(x) for x in rows.column("keys").to_pylist()]
    keys, counts = summed(asked, [unpacked(x, np.int64) for x in rows.column("counts").to_pylist()])
    contexts = np.searchsorted(keys, WORD_KEY)
    logs = context_logs(keys[:contexts], counts[:contexts], near).astype(np.float32)
    seen = counts[contexts:]
    numbers = np.zeros((2, len(blocks)), dtype=np.int64)
    numbers[:, 0] = seen.sum(), (seen > 0).sum()  # once per bucket
    places = [np.searchsorted(keys, x) for x in asked]
    return pa.table(
        {
            "block": pa.array(blocks, pa.int64()),
            "bucket": rows.column("bucket"),
            "logs": pa.array([packed(logs[at[at < contexts]]) for at in places], pa.binary()),
            "seen": pa.array([packed(seen[at[at >= contexts] - contexts]) for at in places], pa.binary()),
            "tokens": pa.array(numbers[0]),
            "kinds": pa.array(numbers[1]),
        }
    )


class Places:
    """Positions of sorted keys through a hash table; keys that share a place are searched."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(10, len(keys).bit_length() + 2)
        self.at = np.zeros(1 << self.bits, dtype=np.int32)
        self.at[self._place(keys)] = np.arange(len(keys))

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(U64) * U64(0x9E3779B97F4A7C15) >> U64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self.at[self._place(keys)]
        other = np.flatnonzero(self.keys[at] != keys)
        at[other] = np.searchsorted(self.keys, keys[other])
        return at


SCORES = "doc_id {kind}, held_out boolean, n_words bigint, known_words bigint, word_logs double, score double"


def _score_block(rows: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    """The block's keys again, the answers put in their places, and the sums per document."""
    keys, _ = block_keys(rows)
    logs, seen = np.zeros(len(keys)), np.zeros(len(keys), dtype=np.int64)
    places = dealt(keys, buckets)
    for bucket, own_logs, own_seen in zip(*(answers.column(c).to_pylist() for c in ("bucket", "logs", "seen")), strict=True):
        at = places[bucket]
        split = np.searchsorted(keys[at], WORD_KEY)
        logs[at[:split]] = unpacked(own_logs, np.float32)
        seen[at[split:]] = unpacked(own_seen, np.int64)
    of_word = keys >= WORD_KEY
    logs[of_word] = np.log10(seen[of_word] + 0.5)
    place = Places(keys)
    out = []
    for batch in rows.to_batches():
        for part in parts(batch.column("text")):
            contexts, first = context_keys(part)
            found = words(part)
            at = place[word_keys(found)]
            own = batch.slice(part.first, part.last - part.first)
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        own.column("doc_id"),
                        own.column("held_out"),
                        pa.array(found.counts()),
                        pa.array(_per_row((seen[at] > 0).astype(np.int64), found.first)),
                        pa.array(_per_row(logs[at], found.first)),
                        pa.array(np.add.reduceat(logs[place[contexts]], first[:-1])),
                    ],
                    names=["doc_id", "held_out", "n_words", "known_words", "word_logs", "score"],
                )
            )
    return pa.Table.from_batches(out)


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[first[1:]] - upto[first[:-1]]


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: token counts, the word model's and the byte model's log10
    probability of the whole text.

    Trained on the rows that are not held out. A null or empty text has one token, its end.
    Without training rows all bytes are equally likely and no token is known. Only doc_id and
    text are read; an empty table gives an empty table, repeated rows equal results.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    size, trained = rows.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(~F.col("held_out"))
    ).first()
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(blocks)).cast("bigint")
    rows = rows.withColumn("block", block)
    counts = stored(
        rows.groupBy("block").applyInArrow(lambda k, t: _count_block(k, t, buckets), COUNTS), "ppm-counts"
    )
    pairs = counts.mapInArrow(_byte_pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    near = np.zeros(1 << 16, dtype=np.int64)
    for pair, n in pairs.collect():
        near[pair] = n
    near = near.reshape(256, 256)
    answers = stored(
        counts.groupBy("bucket").applyInArrow(lambda k, t: _answer_bucket(k, t, near), VALUES),
        "ppm-values",
    )
    tokens, kinds = answers.agg(F.sum("tokens"), F.sum("kinds")).first()
    all_tokens = (tokens or 0) + trained
    all_kinds = (kinds or 0) + (trained > 0)
    scored = (
        rows.groupBy("block")
        .cogroup(answers.select("block", "bucket", "logs", "seen").groupBy("block"))
        .applyInArrow(lambda r, a: _score_block(r, a, buckets), SCORES.format(kind=kind))
    )
    base = math.log10(all_tokens + 0.5 * (all_kinds + 1))
    return scored.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known_words") + int(trained > 0)).alias("n_known"),
        F.lit(all_tokens).cast("bigint").alias("train_tokens"),
        (F.col("word_logs") + math.log10(trained + 0.5) - (F.col("n_words") + 1) * base).alias("base_score"),
        "score",
    )
