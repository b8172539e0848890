"""The verdict of the quality rules against the same estimate in numpy, group by group."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import SCHEMA, prose

from payrisk.llm import quality


@pytest.fixture(scope="module")
def rows():
    r, out = random.Random(3), []
    for i in range(420):
        words = prose(r, r.randrange(20, 200), 4000).split()
        kind = i % 20
        if kind == 3:  # like a table
            words = [w for x in words for w in ((x, "|") if r.random() < 0.5 else (x,))]
        if kind == 7:  # a line again and again
            line = " ".join(words[:6])
            words = [*words, "\n", line, "\n", line, "\n", line, "\n"]
        if kind == 11:  # very long words
            words = [w * 3 for w in words]
        source = "tiny" if i % 70 == 0 else "hot" if i % 3 else None
        out.append((i, " ".join(words), "en" if i % 2 else "de", source, 1))
    return out


def spread(x, weights=None):
    """(centre, scatter with the least variances) of rows, or of rows and a prior's moments."""
    n, s, q = weights
    m = s / n
    scatter = q / n - np.outer(m, m)
    np.fill_diagonal(scatter, np.maximum(np.diag(scatter), 0))
    return m, scatter + np.diag(np.square(quality.LEAST_SD))


def moments(x):
    return len(x), x.sum(axis=0), x.T @ x


def distances(x, centre, scatter):
    z = x - centre
    return np.einsum("ij,jk,ik->i", z, np.linalg.inv(scatter), z)


def nearest(x, d2):
    bins = np.floor(np.log2(d2 + 1e-6) * quality.BINS_PER_DOUBLING)
    keep = np.zeros(len(x), dtype=bool)
    upto = 0
    for b in np.unique(bins):
        if upto >= quality.KEEP_PART * len(x):
            break
        keep |= bins == b
        upto += (bins == b).sum()
    return x[keep]


def estimate(x, prior=None):
    found = []
    median = np.sort(x, axis=0)[int(np.ceil(len(x) / 2)) - 1]
    for centre in (x.mean(axis=0), median):
        scatter = np.diag(np.square(quality.START_SD))
        for _ in range(quality.STEPS):
            own = moments(nearest(x, distances(x, centre, scatter)))
            total = own if prior is None else tuple(a + b / prior[0] * quality.PRIOR for a, b in zip(own, prior, strict=True))
            centre, scatter = spread(x, total)
        found.append((np.linalg.det(scatter), centre, scatter, own))
    return min(found, key=lambda f: f[0])[1:]


def test_verdict_equals_numpy(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    judged = quality.judge(docs).collect()
    counted = quality.statistics(docs).withColumns(quality._vector()).collect()
    vectors = {r.doc_id: np.array([r[c] for c in quality.STATS]) for r in counted}
    good = [r for r in counted if not r.base_failed]
    _, _, prior = estimate(np.array([vectors[r.doc_id] for r in good]))
    groups = {}
    for r in counted:
        groups.setdefault((r.lang, r.source), []).append(r)
    kept = {}
    for members in groups.values():
        fine = [r for r in members if not r.base_failed]
        centre, scatter, _ = estimate(np.array([vectors[r.doc_id] for r in fine]), prior)
        for r in members:
            d2 = distances(vectors[r.doc_id][None, :], centre, scatter)[0] / quality.CONSISTENCY
            kept[r.doc_id] = (not r.base_failed and d2 <= quality.CUT, d2)
    assert len(judged) == len(rows)
    for r in judged:
        assert r.distance2 == pytest.approx(kept[r.doc_id][1], rel=1e-6)
        assert r.kept == kept[r.doc_id][0]
    gone = [r.doc_id % 20 for r in judged if not r.kept and not r.base_failed]
    assert {3, 11} <= set(gone) and sum(k not in (3, 7, 11) for k in gone) <= 0.02 * len(rows)


def test_columns_named_like_its_own_and_one_document_more(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({quality.GROUP: F.lit("mine"), "d2": F.lit("too")})
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert {(r[quality.GROUP], r.d2) for r in kept.collect()} == {("mine", "too")}
    few = [r for r in rows if r[3] == "tiny"]
    ids = {r.doc_id for r in quality.kept_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    more = [*rows, (9999, few[0][1], few[0][2], "tiny", 1)]
    again = {r.doc_id for r in quality.kept_documents(spark.createDataFrame(more, SCHEMA)).collect()}
    assert len(ids ^ (again - {9999})) <= 2  # one document more does not turn a group's verdicts over
