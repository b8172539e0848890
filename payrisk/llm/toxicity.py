"""Toxicity by compression distance.

Two zstandard raw-content dictionaries are made from labelled text: an ordinary one from
windows of ordinary documents, and a toxic one from the same windows with a lexicon behind
them: the words that are distinctive of toxic documents, each by its own counts. Every window of a text is encoded with both; a
window is the more toxic the more bytes the toxic dictionary saves. How a document's savings
turn into a score is calibrated on the labelled sample.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.llm.common import crc_part, stored, text_or_empty

HELD_OUT = (4, 2)  # crc32 of the id modulo 4 is 2
# The classifier is fitted on a bounded sample of labelled documents per class, of which so
# many characters are read.
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 8_000
CALIBRATED = 1_000  # of them per class, for the calibration
ORDINARY_BYTES = 64_000  # of the ordinary dictionary
# A word is distinctive if it is in so many toxic documents, this many times as common there
# by odds, and the likelihood ratio statistic of its document counts is this great. Chance
# passes 15 once in 10,000 words; the bound is higher, as words found only now and then save
# bytes in ordinary documents too.
LEAST_DOCS = 3
LEAST_ODDS = 4.0
LEAST_RATIO = 45.0
# A text is a near copy if more than this part of its runs of so many words are in texts before.
COPY_PART = 0.5
COPY_WORDS = 5
WINDOW_WORDS = 8
LEVEL = 6
TOP_WINDOWS = 5
STRONG = (3, 4, 5)  # bytes saved that make a window a strong one, by three measures
FEATURES = 3 + 2 * len(STRONG)
THRESHOLD = 0.3
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held_out() -> Column:
    return crc_part(HELD_OUT[0]) == HELD_OUT[1]


def windows(text: str) -> list[str]:
    words = WORD.findall(text)
    return [" ".join(words[i : i + WINDOW_WORDS]) for i in range(0, len(words), WINDOW_WORDS)]


@dataclass(frozen=True)
class Model:
    """The two dictionaries and the calibration: weights of the features and their scales."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]


@lru_cache(maxsize=2)
def _encoders(ordinary: bytes, toxic: bytes) -> tuple:
    out = []
    for content in (ordinary, toxic):
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=own, write_content_size=False).compress)
    return tuple(out)


def features(text: str, ordinary: bytes, toxic: bytes) -> list[float]:
    """Bytes saved by the toxic dictionary over the windows of a text: greatest, mean of the
    greatest few, mean of all, and the shares and numbers of strong windows."""
    plain, other = _encoders(ordinary, toxic)
    saved = []
    for window in windows(text):
        data = window.encode()
        saved.append(len(plain(data)) - len(other(data)))
    if not saved:
        return [0.0] * FEATURES
    top = sorted(saved, reverse=True)[:TOP_WINDOWS]
    strong = [sum(s >= least for s in saved) for least in STRONG]
    return [
        top[0],
        sum(top) / TOP_WINDOWS,
        sum(saved) / len(saved),
        *[n / len(saved) for n in strong],
        *[float(np.log1p(n)) for n in strong],
    ]


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[dict[int, list[str]], dict[int, int]]:
    """(lower-cased texts, number of labelled documents) by class, held-out rows left out.

    Equal texts count once in the sample, so a page copied often does not become a class of
    its own. The sample follows a hash of the text; only hashes are ranked, and the texts of
    those chosen are read afterwards.
    """
    read = docs.filter(~held_out() & (F.length("text") > 0)).withColumn("place", F.xxhash64("text"))
    known = read.select("doc_id", "place").join(
        labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct(), "doc_id"
    )
    order = Window.partitionBy("toxic").orderBy("place")
    chosen = stored(
        known.select("toxic", "place")
        .distinct()
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= SAMPLE_DOCS),
        "toxic-sample",
    )
    short = F.substring(F.lower("text"), 1, SAMPLE_CHARS).alias("text")
    pages = (
        read.select("place", short)
        .join(chosen.select("place").distinct(), "place", "left_semi")
        .groupBy("place")
        .agg(F.min("text").alias("text"))
    )
    rows = chosen.join(pages, "place")
    texts: dict[int, list[str]] = {0: [], 1: []}
    for toxic, text in rows.orderBy("toxic", "rank").select("toxic", "text").collect():
        texts[toxic].append(text)
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    return texts, counts


def thinned(texts: list[str]) -> list[str]:
    """The texts without near copies of those before them."""
    kept, seen = [], set()
    for text in texts:
        found = WORD.findall(text)
        runs = {hash(tuple(found[i : i + COPY_WORDS])) for i in range(max(1, len(found) - COPY_WORDS + 1))}
        if len(runs & seen) <= COPY_PART * len(runs):
            kept.append(text)
            seen |= runs
    return kept


def distinctive(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Words far more common in toxic documents, those of the greatest log-odds last.

    Every word is judged by its own counts, so no other word can push it out.
    """
    inside, outside = (
        Counter(w for text in texts for w in set(WORD.findall(text))) for texts in (toxic, ordinary)
    )
    part = len(toxic) / (len(toxic) + len(ordinary))
    odds, kept = {}, []
    for w, n in inside.items():
        m = outside[w]
        ratio = 2 * (n * np.log(n / ((n + m) * part)) + (m * np.log(m / ((n + m) * (1 - part))) if m else 0.0))
        odds[w] = np.log((n + 0.5) / (len(toxic) + 1) * (len(ordinary) + 1) / (m + 0.5))
        if n >= LEAST_DOCS and odds[w] >= np.log(LEAST_ODDS) and ratio >= LEAST_RATIO:
            kept.append(w)
    return sorted(kept, key=lambda w: (odds[w], w))


def _logistic(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (importance * (p - y)) + ridge @ w
        curve = (x * (importance * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model, or a constant score if only one class, or none, is labelled."""
    texts, counts = labelled_sample(docs, labels)
    if not texts[0] or not texts[1]:
        return 1.0 if texts[1] else 0.0
    texts = {c: thinned(texts[c]) for c in texts}
    pieces = [w for text in texts[0] for w in windows(text)]
    step = max(1, len(pieces) * 50 // ORDINARY_BYTES)
    ordinary = "\n".join(pieces[::step]).encode()[-ORDINARY_BYTES:]
    toxic = ordinary + (" " + " ".join(distinctive(texts[1], texts[0])) + " ").encode()
    rows = [(text, y) for y in (0, 1) for text in texts[y][:CALIBRATED]]
    x = np.array([features(text, ordinary, toxic) for text, _ in rows])
    y = np.array([y for _, y in rows], dtype=float)
    means, scales = x.mean(axis=0), x.std(axis=0) + 1e-9
    # Each class stands for as many documents as are labelled with it.
    size = {c: counts[c] / sum(y == c) for c in (0, 1)}
    importance = np.where(y == 1, size[1], size[0]) * len(y) / sum(counts.values())
    weights = _logistic((x - means) / scales, y, importance)
    return Model(ordinary, toxic, tuple(weights), tuple(means), tuple(scales))


def _score(batches: Iterator[pa.RecordBatch], model: Model | float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if isinstance(model, float):
            scores = np.full(batch.num_rows, model)
        else:
            x = np.array([features(t, model.ordinary, model.toxic) for t in batch.column("text").to_pylist()])
            z = (x.reshape(-1, FEATURES) - model.means) / model.scales @ model.weights[:-1] + model.weights[-1]
            scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "score"],
        )


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row of ``docs``.

    Null and empty texts have no window and get the score of a text without savings. Only
    doc_id and text are read; rows are scored by a map, whole texts window by window.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), F.lower(text_or_empty()).alias("text"))
    scored = rows.mapInArrow(partial(_score, model=model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
