"""Durable cut points in long plans."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list[str]] = []  # tables written in each open scope


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    The cluster names a shared folder in `spark.checkpoint.dir`; it is used as
    is. Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="panelweave-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """Folder of this application's written tables, in the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}"


def durable(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the checkpoint folder and continue from it.

    Used where a result is read more than once, and where later steps refer to
    physical properties of a sorted result (its partition numbers): the written
    table stays the same when executors are lost. Unlike a cached or
    checkpointed RDD it has a known size, so joins with it can be broadcast,
    and its readers only read the columns they need.
    """
    path = f"{scratch_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table of a `durable` result that no later step reads."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        _delete(df.sparkSession, unquote(folder))


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query that ends inside this scope, such as the writing of a `durable` table.

    Spark otherwise keeps them until the driver collects its garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that `durable` writes inside this scope when it ends.

    A long session on shared storage wraps each query and the writing of its
    result in a scope; results that are still lazy must be used inside it.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's written tables."""
    _delete(spark, scratch_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
