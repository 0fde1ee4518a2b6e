"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE sizes shuffle partitions at run time, splits skewed join partitions and
# turns a join into a broadcast join only after it has measured the small side.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "wxrisk", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset (a local test session) a folder of our own is set. On a
    cluster that would lose data with the machine, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    root = tempfile.mkdtemp(prefix="wxrisk-")
    spark.sparkContext.setCheckpointDir(root)
    return shared_root(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one run's intermediate table below the shared folder."""
    return f"{shared_root(spark)}/wxrisk-scratch/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """(file system, path) handles of the cluster's storage layer."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), handle


def remove_folder(spark: SparkSession, path: str) -> None:
    files, handle = file_system(spark, path)
    files.delete(handle, True)


class TableStages:
    """Writes an intermediate table to the shared folder and reads it back.

    Passed as ``stage`` to operators whose input is used several times: the
    input is then computed once, survives a lost executor, and later steps know
    its size and read only the columns they need.
    """

    _blocks: list[list[TableStages]] = []

    def __init__(self, spark: SparkSession, label: str = "stage"):
        self.spark = spark
        self.root = scratch_path(spark, label)
        if self._blocks:
            self._blocks[-1].append(self)

    def __call__(self, df, name: str):
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Deletes this run's intermediate tables, once nothing reads them any more."""
        remove_folder(self.spark, self.root)


@contextmanager
def scratch_block():
    """Deletes, at its end, the intermediate tables of all stages made inside.

    For a job that writes the result of operators inside the block: what they staged is read by then.
    """
    made: list[TableStages] = []
    TableStages._blocks.append(made)
    try:
        yield
    finally:
        TableStages._blocks.remove(made)
        for stage in made:
            stage.remove()


def unstaged(df, name: str):
    """The default stage: keep the plan lazy."""
    return df
