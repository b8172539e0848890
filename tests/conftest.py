from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from payrisk import create_session  # noqa: E402
from payrisk.schema import TX_SCHEMA  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = create_session(
        "payrisk-tests",
        master="local[4]",
        shuffle_partitions=4,
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_tx(spark):
    """Transactions from dicts; what a dict leaves out takes a plain default."""
    plain = {
        "step": 1, "type": "TRANSFER", "amount": 100.0, "nameOrig": "C1",
        "oldbalanceOrg": 500.0, "newbalanceOrig": 400.0, "nameDest": "M1",
        "oldbalanceDest": 0.0, "newbalanceDest": 100.0, "isFraud": 0, "isFlaggedFraud": 0,
    }

    def make(*rows: dict):
        filled = [tuple({**plain, **row}[c] for c in TX_SCHEMA.fieldNames()) for row in rows]
        return spark.createDataFrame(filled, TX_SCHEMA)

    return make


@pytest.fixture(scope="session")
def scored_small(spark, tmp_path_factory):
    """The rule-scored smallest tables, stored."""
    from payrisk.plans.catalog import rule_scored

    path = str(tmp_path_factory.mktemp("scored") / "rows")
    rule_scored(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def tx_small(spark, tmp_path_factory):
    from payrisk.sources import transactions

    path = str(tmp_path_factory.mktemp("tx") / "rows")
    transactions(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)
