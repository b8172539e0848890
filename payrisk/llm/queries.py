"""Registered queries of the subpackage and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from payrisk.llm import (
    decontamination,
    filter_audit,
    langid,
    mixing,
    near_dedup,
    periodic_runs,
    ppm,
    quality,
    secret_scan,
    sharding,
    toxicity,
    url_filter,
    vector_dedup,
)
from payrisk.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


QUERIES: dict[str, Query] = {
    "op1_toxicity": lambda spark, sf_dir: toxicity.toxicity_table(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ),
    "op2_lm_score": over("documents", ppm.score_texts),
    "op3_url_filter": over("pages", url_filter.url_table),
    "op4_sharding": over("documents", sharding.shard_table),
    "op5_decontamination": lambda spark, sf_dir: decontamination.leak_table(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ),
    "op6_near_dedup": over("documents", near_dedup.near_table),
    "op7_secret_scan": over("documents", secret_scan.scan),
    "op8_mixing": over("documents", mixing.mix_table),
    "op10_language_id": over("documents", langid.lang_table),
    "op9_quality": over("documents", quality.quality_table),
    "op11_vector_dedup": vector_dedup.vector_table,
    "op12_periodic_runs": over("documents", periodic_runs.runs_table),
    "op13_filter_audit": filter_audit.audit_table,
}

ORACLES: dict[str, str] = {
    "op3_url_filter": url_filter.sql(),
    "op8_mixing": mixing.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
