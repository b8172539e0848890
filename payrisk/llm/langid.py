"""Language identification by compression.

Per language a zstandard raw-content dictionary is filled with sample text, lower-cased. A text is encoded
with every dictionary; the language whose dictionary gives the fewest bytes is its language.
Texts are cut into blocks that are encoded apart, so a dictionary helps all of a long text
alike. Narrow margins are marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.llm.common import crc_part, text_or_empty

# The classifier is fitted on a bounded sample per language: so many documents, so many
# characters of each.
SAMPLE_DOCS = 80
SAMPLE_CHARS = 1500
SLICES = 64
BLOCK = 4096
LEVEL = 5
HELD_OUT = (4, 2)  # crc32 of the id modulo 4 is 2
UNKNOWN = "und"
# Scale of the relative margin that becomes the score, and the margin under which a
# prediction counts as rejected.
MARGIN_SCALE = 0.02
REJECT_MARGIN = 0.005


def held_out() -> Column:
    return crc_part(HELD_OUT[0]) == HELD_OUT[1]


def _least(hashes: DataFrame, keys: list) -> DataFrame:
    """The SAMPLE_DOCS least hashes of each group, numbered in ``place``."""
    order = Window.partitionBy(*keys).orderBy("hash")
    return hashes.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_DOCS)


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Sample text per language of the training documents, in the order of a hash of the text.

    Equal texts count once, so a page with many copies fills no dictionary; of a long text a
    piece at a hashed place is taken. Copies meet as hashes, combined map-side. Ranks are cut
    per task, then per slice of a language, before they meet by language: no more than
    SLICES x SAMPLE_DOCS hashes do.
    """
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.select("lang", "text", F.xxhash64("text", F.lit(5)).alias("hash"))
    hashes = known.select("lang", "hash").distinct()
    chosen = _least(_least(hashes, ["lang", F.pmod("hash", F.lit(SLICES))]), ["lang"])
    chosen = chosen.select(F.col("lang").alias("l"), F.col("hash").alias("h"), "place")
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("text", F.lit(7)), room).cast("int") + 1
    piece = F.lower(F.substring("text", start, F.lit(SAMPLE_CHARS))).alias("piece")
    # The places are far smaller than the dictionaries, which every task gets.
    found = known.join(F.broadcast(chosen), (F.col("lang") == F.col("l")) & (F.col("hash") == F.col("h")))
    sample = found.select("lang", "place", piece).groupBy("lang", "place").agg(F.min("piece").alias("piece"))
    texts: dict[str, list[str]] = {}
    for lang, own in sample.orderBy("lang", "place").select("lang", "piece").collect():
        texts.setdefault(lang, []).append(own)
    return {lang: "\n".join(pieces).encode() for lang, pieces in texts.items()}


@lru_cache(maxsize=4)
def compressors(contents: tuple[bytes, ...]) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in contents:
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=own, write_content_size=False))
    return out


def encoded_sizes(text: bytes, encoders: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Bytes of the text with each encoder, summed over its blocks."""
    sizes = np.zeros(len(encoders), dtype=np.int64)
    for start in range(0, max(len(text), 1), BLOCK):
        block = text[start : start + BLOCK]
        for k, encoder in enumerate(encoders):
            sizes[k] += len(encoder.compress(block))
    return sizes


def _predict(
    batches: Iterator[pa.RecordBatch], langs: tuple[str, ...], contents: tuple[bytes, ...]
) -> Iterator[pa.RecordBatch]:
    encoders = compressors(contents)
    for batch in batches:
        preds, scores, margins = [], [], []
        for text, letters in zip(batch.column("text"), batch.column("letters").to_pylist(), strict=True):
            if not letters or not langs:
                preds.append(UNKNOWN)
                scores.append(0.0)
                margins.append(0.0)
                continue
            sizes = encoded_sizes(text.as_py().encode(), encoders)
            order = np.argsort(sizes, kind="stable")
            best = int(order[0])
            others = sizes[order[1:]]
            margin = float((others[0] - sizes[best]) / others[0]) if len(others) else 1.0
            weights = np.exp(-np.minimum((sizes - sizes[best]) / (MARGIN_SCALE * sizes[best]), 700))
            preds.append(langs[best])
            scores.append(float(1.0 / weights.sum()))
            margins.append(margin)
        kept = [batch.column(i) for i in range(batch.num_columns - 2)]
        names = batch.schema.names[:-2]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())],
            names=[*names, "lang_pred", "score", "margin"],
        )


def identify(docs: DataFrame, learned: dict[str, bytes]) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin and rejected, one row per row of ``docs``.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing
    was learned. Ties go to the language first in code-point order. Only doc_id and text are
    read; an empty table gives an empty table, repeated rows equal results.
    """
    langs = tuple(sorted(learned))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id",
        held_out().alias("held_out"),
        F.lower(text_or_empty()).alias("text"),
        text_or_empty().rlike(r"\p{L}").alias("letters"),
    )
    guess = partial(_predict, langs=langs, contents=tuple(learned[x] for x in langs))
    found = rows.mapInArrow(
        guess, f"doc_id {kind}, held_out boolean, lang_pred string, score double, margin double"
    )
    return found.withColumn("rejected", F.col("margin") < REJECT_MARGIN)


def lang_table(docs: DataFrame) -> DataFrame:
    return identify(docs, dictionaries(docs))
