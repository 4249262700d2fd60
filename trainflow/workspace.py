"""Shared folders for tables a job writes on the way to its result."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The folder of a local session that names none: goes with the process.
_OWN: list[tempfile.TemporaryDirectory] = []
# Folders made inside the running ``released`` blocks.
_BLOCKS: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must reach.

    Only a local session may go without the setting: it gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    current = context.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        _OWN.append(tempfile.TemporaryDirectory(prefix="trainflow-", ignore_cleanup_errors=True))
        context.setCheckpointDir(_OWN[-1].name)
        current = context.getCheckpointDir()
    return current.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared folder."""
    path = f"{shared_folder(spark)}/trainflow/{name}-{uuid.uuid4().hex}"
    if _BLOCKS:
        _BLOCKS[-1].append(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes the shared folders made in the block when it ends, also if it fails.

    For runs that keep their results elsewhere; tables made in the block cannot be read after it.
    """
    _BLOCKS.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in _BLOCKS.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new shared table and read it back.

    Cuts the lineage, survives lost executors, and fixes values that depend on the layout.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
