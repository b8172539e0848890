"""What several of the operators share: tables, stored intermediates, exact 0/1 text rules."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.session import current_workspace

ROOT = str(Path(__file__).resolve().parents[2])

# The characters between words, and their regular expression.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
ROWS_PER_TASK = 20_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Python workers are told where this package lies."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows written once to the shared folder and read back.

    Cuts the lineage, so a lost executor costs a read and not the work before it, and gives
    the optimizer the true size of what follows. The table goes with the open workspace.
    """
    return current_workspace(df.sparkSession).stored(df, name)


def narrowed(df: DataFrame, rows: int) -> DataFrame:
    """As many tasks as so many rows need: small tables between rounds stay in few files."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(value: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(value, UPPER, UPPER.lower())


def words_of(value: Column) -> Column:
    """The words of a text, in order: runs of characters other than ``SPACES``."""
    return F.filter(F.split(value, SPACE_RUN), lambda w: w != "")


def crc_part(parts: int, key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as empty text."""
    as_text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % F.lit(parts)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas use it again."""
    return F.transform(F.array(value), body)[0]


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
