"""Which batches of a stream are complete: a log that writers append to and readers list."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from payrisk.session import file_system


def note_commit(spark: SparkSession, log: str, run: str, batch_id: int) -> None:
    """Note that all of a batch is written. The note appears whole or not at all, by a rename;
    a batch that is repeated after its note finds it there and leaves it."""
    target, files = file_system(spark, f"{log}/run={run}/batch_id={batch_id}")
    draft, _ = file_system(spark, f"{log}/_drafts/{uuid.uuid4().hex}")
    files.create(draft, True).close()
    files.mkdirs(target.getParent())
    if not files.rename(draft, target) and not files.exists(target):
        raise RuntimeError(f"cannot note batch {batch_id} in {log}")
    files.delete(draft, False)


def committed_batches(spark: SparkSession, log: str) -> list[tuple[str, int]]:
    """(run, batch) of every noted batch, in order: one file name each."""
    root, files = file_system(spark, log)
    found = []
    if files.exists(root):
        for run in files.listStatus(root):
            name = run.getPath().getName()
            if name.startswith("run="):
                for note in files.listStatus(run.getPath()):
                    found.append((name[4:], int(note.getPath().getName().removeprefix("batch_id="))))
    return sorted(found)


def read_committed(
    spark: SparkSession, log: str, path: str, schema: T.StructType, fmt: str = "csv"
) -> DataFrame:
    """What a sink of ``batch_files`` holds of the noted batches; rows of others are not seen."""
    folders = [f"{path}/run={run}/batch_id={batch}" for run, batch in committed_batches(spark, log)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).format(fmt).load(folders)
