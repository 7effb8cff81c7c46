"""Intermediate tables in the cluster's shared folder: they cut lineage and outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_scope: ContextVar[str | None] = ContextVar("tidemark_scratch", default=None)
#: Folders written outside any scope, for ``release``.
_loose: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session. Only a session whose executors are threads of the driver may do without one."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    scope = _scope.get()
    path = f"{scope or shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
    if scope is None:
        _loose.append(path)
    return path


def _remove(spark: SparkSession, folder: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables written inside are removed at the end: for jobs that return tables, not DataFrames."""
    folder = f"{shared_folder(spark)}/tidemark-job-{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        _remove(spark, folder)


def release(spark: SparkSession) -> int:
    """Remove the scratch tables behind DataFrames that were returned and have been read; says how many."""
    paths, _loose[:] = _loose[:], []
    for path in paths:
        _remove(spark, path)
    return len(paths)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``make`` returns, written; scratch tables that were written on the way to it are removed."""
    path = scratch_path(spark)
    with scratch_scope(spark):
        table = make()
        table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def written(df: DataFrame) -> DataFrame:
    """Write once, read back: every later use sees the same rows without recomputing them."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
