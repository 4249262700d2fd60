"""Append-only record tables: newest version wins, deletes are marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, key: Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """The row with the highest version of each key.

    An aggregation with partial results, so a key with very many versions is no burden.
    """
    order = [version] if isinstance(version, str) else list(version)
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*key).agg(best.alias("best")).select(*key, *[F.col("best")[c].alias(c) for c in rest])


def current(log: DataFrame, key: Sequence[str], version: str | Sequence[str], deleted: str) -> DataFrame:
    """State of a log after all inserts, updates and deletes."""
    return newest(log, key, version).where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)


def find(log: DataFrame, key: Sequence[str], version: str | Sequence[str], deleted: str, query: Column) -> DataFrame:
    """Current records that meet a condition."""
    return current(log, key, version, deleted).where(query)
