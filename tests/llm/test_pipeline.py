"""The pipeline's stages one by one, and as a whole."""

from __future__ import annotations

from collections import Counter

import pytest
from samples import SCHEMA, documents, prose

import __spark_entry__ as contract
import corpus_pipeline
from payrisk.llm import mixing, quality


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    place = str(tmp_path_factory.mktemp("corpus"))
    r = random.Random(9)
    item = prose(r, 30, 4000)
    rows = documents(3) + [(700, prose(r, 40, 4000) + " " + item, "en", "hot", 0)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{place}/benchmark.parquet")
    return place


def test_stages_and_result(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, folder).cache()
        kept.append(docs.count())
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}, name
        if name == "quality_rules":
            assert ids == {r.doc_id for r in quality.judge(before).filter("kept").select("doc_id").collect()}
            assert 700 in ids
        if name == "decontamination":
            assert 700 not in ids and len(ids) == kept[-2] - 1
        if name == "mixing":
            assert sum(r.taken for r in mixing.mix_table(before).collect()) > 0
        if name != "sharding":
            assert docs.columns == columns
    assert docs.columns == [*columns, "shard"]
    whole = Counter((r.doc_id, r.shard) for r in corpus_pipeline.run(spark, folder).select("doc_id", "shard").collect())
    assert whole == Counter((r.doc_id, r.shard) for r in docs.select("doc_id", "shard").collect())


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_all_are_registered():
    names = contract.queries()
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert {type(sql) for sql in contract.oracle_sql().values()} == {str}
    assert set(contract.oracle_sql()) <= set(names)
