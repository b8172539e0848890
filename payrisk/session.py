"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def create_session(
    app_name: str = "payrisk",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Spark session with the settings the library counts on.

    Memory, executors and shuffle width belong to the cluster's own configuration and
    are set only when passed. Adaptive execution sizes shuffles by bytes and splits
    skewed join partitions, so no fixed partition count is written down here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


class Workspace:
    """Folders below ``shared_dir`` that live as long as what reads them.

    Use it as ``with workspace(spark) as work``: tables that are stored inside, by whatever
    function, are deleted at its end, also after a failure. Write what is to stay before, or
    keep it in the workspace around this one with ``outer``.
    """

    def __init__(self, spark: SparkSession, outer: Workspace | None = None):
        self.spark, self.outer, self._folders = spark, outer, []

    def folder(self, name: str) -> str:
        path = new_folder(self.spark, name)
        self._folders.append(path)
        return path

    def stored(self, df: DataFrame, name: str = "rows") -> DataFrame:
        """Rows written once and read back: a cut lineage and a true size for what follows."""
        path = f"{self.folder(name)}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self) -> None:
        while self._folders:
            _delete_folder(self.spark, self._folders.pop())


class _SessionWorkspace(Workspace):
    """Of tables stored outside any workspace: they go when the session's JVM ends."""

    def folder(self, name: str) -> str:
        folder = new_folder(self.spark, name)
        path, files = file_system(self.spark, folder)
        files.deleteOnExit(path)
        return folder


_open: ContextVar[Workspace | None] = ContextVar("payrisk_workspace", default=None)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[Workspace]:
    own = Workspace(spark, current_workspace(spark))
    token = _open.set(own)
    try:
        yield own
    finally:
        _open.reset(token)
        own.delete()


def current_workspace(spark: SparkSession) -> Workspace:
    """The innermost open workspace of this thread, else that of the session."""
    return _open.get() or session_workspace(spark)


def session_workspace(spark: SparkSession) -> Workspace:
    """For what several calls share: not deleted by any workspace that happens to be open."""
    return _SessionWorkspace(spark)


def file_system(spark: SparkSession, path: str):
    """(path, file system) of Hadoop, for any store that Spark can write to."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession, name: str) -> str:
    folder = f"{shared_dir(spark)}/payrisk-{name}-{uuid.uuid4().hex}"
    path, files = file_system(spark, folder)
    files.mkdirs(path)
    return folder


def _delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = file_system(spark, folder)
    files.delete(path, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new shared folder that goes with the open workspace, else with the session's JVM."""
    return current_workspace(spark).folder(name)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where it is unset, a folder in the
    session's warehouse is used, unless that is a folder of the driver's own disk and the
    executors are on other machines: then this fails, as they would not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if not (named or current):
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        _, files = file_system(spark, warehouse)
        if files.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share: "
                f"the warehouse {warehouse} is on the driver's disk"
            )
        named = f"{warehouse}/_payrisk"
    if not current:
        spark.sparkContext.setCheckpointDir(named or current)
    return named or current
