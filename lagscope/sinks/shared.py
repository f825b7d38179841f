"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that all machines of the cluster share.

    The cluster names it in ``spark.checkpoint.dir``. Only a session in local mode
    falls back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{tempfile.gettempdir()}/lagscope-{context.applicationId}"
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _located(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder, if there is one."""
    files, place = _located(spark, path)
    files.delete(place, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder for a run's own tables, removed when the run ends or fails."""
    path = shared_dir(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)


def written(df: DataFrame, path: str) -> DataFrame:
    """The frame as a written table: its input is not read again when executors
    are lost or when several reports use it, and its size is known."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """The rows in the shared folder, for as long as the frame is in use."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)
