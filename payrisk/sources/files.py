"""File sources and sinks."""

from __future__ import annotations

import uuid
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payrisk.schema import SCORED_SCHEMA, TX_SCHEMA
from payrisk.session import current_workspace, file_system

CsvMode = Literal["PERMISSIVE", "DROPMALFORMED", "FAILFAST"]
LINE = "rejected_line"


def read_transactions(
    spark: SparkSession,
    path: str,
    num_partitions: int | None = None,
    mode: CsvMode = "PERMISSIVE",
) -> DataFrame:
    """Transactions from CSV with a header. The header must name the schema's columns.

    A field that does not fit its type is NULL in PERMISSIVE mode, its row is left out in
    DROPMALFORMED, whichever columns are read later, and a job that reads it fails in FAILFAST.
    ``read_checked_transactions`` keeps the lines apart. ``num_partitions`` repartitions round-robin, a full shuffle: for small inputs only.
    """
    if mode == "DROPMALFORMED":
        df, _ = read_checked_transactions(spark, path)
    else:
        reader = spark.read.schema(TX_SCHEMA).option("header", True).option("enforceSchema", False)
        df = reader.option("mode", mode).csv(path)
    return df.repartition(num_partitions) if num_partitions else df


def read_checked_transactions(
    spark: SparkSession, path: str, schema: T.StructType = TX_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines): every data line of the CSV is in one of them.

    A line is rejected, as it stands in the file, if it has too few or too many fields or one
    that does not fit its type. All fields are parsed whichever are read later, so the answer
    does not depend on the query; for that the parsed table is stored once.
    """
    wide = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    parsed = (
        spark.read.schema(wide)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", False)
        .csv(path)
    )
    kept = current_workspace(spark).stored(parsed, "checked")
    good = kept.filter(F.col(LINE).isNull()).drop(LINE)
    return good, kept.filter(F.col(LINE).isNotNull()).select(LINE)


def read_csv_parts(
    spark: SparkSession, folder: str, schema: T.StructType, may_be_missing: bool = True
) -> DataFrame:
    """All CSV parts of a folder as one table; a missing folder gives no rows, or with
    ``may_be_missing`` off an error.

    Headers must match the schema, so columns are never taken for one another.
    """
    try:
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .csv(folder)
        )
    except AnalysisException as error:
        if not may_be_missing or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_scored(
    spark: SparkSession, folder: str, extra: tuple[str, ...] = (), may_be_missing: bool = True
) -> DataFrame:
    """An exported scored table, with the text columns it was led by, if any."""
    leading = [T.StructField(name, T.StringType()) for name in extra]
    schema = T.StructType([*leading, *SCORED_SCHEMA.fields])
    return read_csv_parts(spark, folder, schema, may_be_missing)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_processed(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Featured transactions as Parquet, replacing an earlier table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with headers, one file per partition, replacing an earlier table."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_mart(df: DataFrame, path: str) -> None:
    """CSV in a single part file: only for marts of a few rows."""
    write_csv(df.coalesce(1), path)


def write_named_csv(df: DataFrame, path: str) -> None:
    """CSV as one file of exactly this name, with a header: only for results of few rows.

    Spark writes a folder beside it; its single part is then renamed over the target, in one
    step where the file system can, so readers see the old file or the new one.
    """
    spark = df.sparkSession
    folder = f"{path}.{uuid.uuid4().hex}.tmp"
    source, files = file_system(spark, folder)
    try:
        write_csv(df.coalesce(1), folder)
        parts = [s.getPath() for s in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*"))]
        target, _ = file_system(spark, path)
        if len(parts) != 1:
            raise RuntimeError(f"{len(parts)} files in place of one for {path}")
        _rename_over(spark, parts[0], target)
    finally:
        files.delete(source, True)


def _rename_over(spark: SparkSession, source, target) -> None:
    fs = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    qualified = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target)
    context = fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, qualified, options)
