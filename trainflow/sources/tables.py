"""Parquet tables: scans and the ways to write them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, *paths: str, merge: bool = False) -> DataFrame:
    """Scan Parquet at any Hadoop path; ``merge`` gives the union of the columns of all files."""
    return spark.read.option("mergeSchema", str(merge).lower()).parquet(*paths)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None while nothing has been written to the path."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _writer(df: DataFrame, partition_by: Sequence[str]):
    return df.write.partitionBy(*partition_by) if partition_by else df.write


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _writer(df, partition_by).mode("append").parquet(path)


def create(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a new table; fail if there is one."""
    _writer(df, partition_by).mode("errorifexists").parquet(path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table; a partitioned one only in the partitions the rows belong to."""
    writer = _writer(df, partition_by).mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
