"""Every registered query against its SQL twin, or against what must hold without one."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle_check import connect, differences

import __spark_entry__ as contract
from payrisk.plans.catalog import QUERIES, SAMPLE_FRACTION
from payrisk.plans.oracle import oracle_queries

SQL = oracle_queries(SAMPLE_FRACTION)


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "risk_level", "transactions", "total_amount", "avg_amount",
    ]
    assert contract.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) == []


def test_stored_tables_are_shared_between_queries(spark):
    """Queries of several passes over the rule scores write them once per session."""
    from payrisk.plans import catalog

    for name in ("tail_histogram", "probability_histogram", "rule_auc"):
        QUERIES[name](spark, SMALL).collect()
        before = dict(catalog._tables)
    QUERIES["risk_score_histogram"](spark, SMALL).collect()
    assert catalog._tables == before
