"""Buckets from a digest of the key: the same in every run, partitioning and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int) -> Column:
    """Bucket 0 .. ``buckets``-1 from the first 32 bits of the MD5 digest of ``key`` as text."""
    digest = F.md5(key.cast("string").cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.pmod(number, F.lit(buckets).cast("long"))


def percent_bucket(*key: str) -> Column:
    """Bucket 0 .. 99 of a row, from its key columns (one key column hashes as its plain text)."""
    if len(key) == 1:
        return hash_bucket(F.coalesce(F.col(key[0]).cast("string"), F.lit("")), 100)
    return hash_bucket(F.to_json(F.struct(*key)), 100)
