"""Runs registered queries against DuckDB; used by the tests and by hand.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("lineitem", "orders", "customer", "supplier")

SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def sorted_rows(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: column names, types, row count or values. Empty if nothing does."""
    names = sorted(df.columns)
    result = con.sql(sql)
    if sorted(result.columns) != names:
        return [f"columns {names} against {sorted(result.columns)}"]
    types = dict(zip(result.columns, map(str, result.types)))
    found = [
        f"type of {name}: {kind} against {types[name]}"
        for name, kind in df.dtypes
        if SAME_TYPE.get(kind, kind) != types[name]
    ]
    ours = [tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    picks = ", ".join(f'"{n}"' for n in names)
    theirs = con.sql(f"select {picks} from ({sql}) as q").fetchall()
    if len(ours) != len(theirs):
        return [*found, f"{len(ours)} rows against {len(theirs)}"]
    for mine, other in zip(sorted_rows(ours), sorted_rows(theirs)):
        if mine != other:
            return [*found, f"row {mine} against {other}"]
    return found


def main() -> None:
    import __spark_entry__ as contract
    from payrisk import create_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark: SparkSession = create_session(
        master="local[8]", shuffle_partitions=8, spark__driver__memory="8g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        df = query(spark, sf_dir)
        if name in sql:
            outcome = "; ".join(differences(df, con, sql[name])) or "equal"
        else:
            outcome = f"{df.count()} rows, no SQL"
        print(f"{name:32s} {time.time() - started:6.2f}s  {outcome}", flush=True)
    unknown = set(sql) - set(contract.queries())
    print("SQL without a query:", sorted(unknown) or "none")


if __name__ == "__main__":
    main()
