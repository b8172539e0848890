"""Filter audit against plain counting of every order, row by row."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from samples import CLASHING, SCHEMA, documents

from payrisk.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shouting(n: int) -> list[tuple]:
    return [
        (1000 + i, f"LOUD{i} Words # and {'more ' * (i * 7)}", "en", None if i % 2 else "", 0)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def rows():
    return [*documents(), *shouting(12), (None, "one two", "en", "s1", 1), (None, "", "en", "hot", 1)]


@pytest.fixture(scope="module")
def labels():
    marks = [(i, i % 2, (i // 3) % 2) for i in range(0, 120, 2)]
    return [*marks, (4, 1, 0), (6, None, None), (None, 1, 1), (99_999, 1, 1)]


def fails(text: str) -> str:
    w = WORD.findall(text)
    bad = "A" if len(w) < 50 else ""
    bad += "B" if 100 * len(set(w)) < 65 * len(w) else ""
    bad += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
    return bad + ("D" if re.search("[#$%&*|]", text) else "")


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    cells = Counter()
    for r in rows:
        bad = fails(r[1] or "")
        if r[0] is not None and r[0] > first[r[1] or ""]:
            bad += "E"
        cells[r[3] or "", bad, r[0] in good, r[0] in toxic] += 1
    out = {}
    for part in {c[0] for c in cells}:
        own = [(c, n) for c, n in cells.items() if c[0] == part]
        blame = defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                gone = Counter()
                for (_, bad, is_good, is_toxic), n in own:
                    before = any(x in bad for x in order[: step - 1])
                    gone["kept"] += n * (not before and letter not in bad)
                    gone["removed"] += n * (not before and letter in bad)
                    gone["redundant"] += n * (before and letter in bad)
                    gone["unique_fails"] += n * (bad == letter)
                    gone["good_lost"] += n * (not before and letter in bad and is_good)
                    gone["toxic_lost"] += n * (not before and letter in bad and is_toxic)
                out[part, order, step] = gone
                blame[letter] += gone["removed"]
        for (p, order, step), counts in out.items():
            if p == part:
                counts["shapley"] = blame[order[step - 1]]
    return out


def as_dict(df):
    names = [*filter_audit.COUNTS, "shapley"]
    found = df.collect()
    out = {(r.part, r.filter_order, r.step): {n: r[n] for n in names} for r in found}
    assert len(out) == len(found)
    return out


def test_every_order_equals_plain_counts(spark, rows, labels):
    doubled = [*rows, *rows[:40]]
    docs = spark.createDataFrame(doubled, SCHEMA).repartition(5)
    marks = spark.createDataFrame(labels, LABELS)
    got = as_dict(filter_audit.audit(docs, marks))
    want = brute(doubled, labels)
    assert len(got) == 120 * 5 * len({k[0] for k in want})
    for key, counts in want.items():
        assert got[key] == {n: counts[n] for n in got[key]}, key


def test_shapley_shares_add_up(spark, rows, labels):
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    result = filter_audit.audit(docs, marks).cache()
    last = result.filter("step = 5").groupBy("part").agg(F.min("kept").alias("lo"), F.max("kept").alias("hi"))
    assert last.filter("lo != hi").isEmpty()
    removed = result.groupBy("part", "filter_order").agg(F.sum("removed").alias("gone"), F.sum("shapley").alias("all"))
    assert removed.filter(F.col("gone") * math.factorial(5) != F.col("all")).isEmpty()


def test_other_id_types_extra_columns_and_empty_tables(spark, rows, labels):
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    plain = as_dict(filter_audit.audit(docs, marks))
    more = docs.withColumns({c: F.lit("mine") for c in (*CLASHING, "part", "mask", "good", "digest", "n", "letter")})
    padded = F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("doc_id")
    texts = more.select(padded, *[c for c in more.columns if c != "doc_id"])
    assert as_dict(filter_audit.audit(texts, marks.select(padded, "quality", "toxic"))) == plain
    assert as_dict(filter_audit.audit(more, marks.withColumn("source", F.lit(1)))) == plain
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    unlabelled = as_dict(filter_audit.audit(docs, marks.limit(0)))
    assert all(c["good_lost"] == c["toxic_lost"] == 0 for c in unlabelled.values())


def test_more_sources_than_the_recursive_row_limit(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("# two words").alias("text"),
        F.concat(F.lit("s"), "id").alias("source"),
    )
    walk = filter_audit.prefix_steps(filter_audit.mask_cells(docs, spark.createDataFrame([], LABELS)))
    assert walk.count() == 4000 * 325
