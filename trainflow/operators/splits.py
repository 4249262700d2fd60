"""Train/test split and sampling by key: the same rows in every run and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainflow.functions import hash_bucket, percent_bucket

TRAIN = "train"
TEST = "test"


def with_split(df: DataFrame, key: Sequence[str], test_percent: int, output: str = "split") -> DataFrame:
    """Mark each row ``train`` or ``test``; rows with equal keys stay together."""
    in_train = percent_bucket(*key) < F.lit(100 - test_percent)
    return df.withColumn(output, F.when(in_train, F.lit(TRAIN)).otherwise(F.lit(TEST)))


def train_test(df: DataFrame, key: Sequence[str], test_percent: int) -> tuple[DataFrame, DataFrame]:
    in_train = percent_bucket(*key) < F.lit(100 - test_percent)
    return df.where(in_train), df.where(~in_train)


def key_sample(df: DataFrame, key: str, rows_per_million: int) -> DataFrame:
    """A sampling operator: keep about this many rows of each million, chosen by key digest."""
    chosen = hash_bucket(F.coalesce(F.col(key).cast("string"), F.lit("")), 1_000_000)
    return df.where(chosen < F.lit(rows_per_million))


def split_balance(df: DataFrame, split: str, target: str) -> DataFrame:
    """Rows and share of each class in each part."""
    counts = df.groupBy(split, target).agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.groupBy(split).agg(F.sum("cnt").alias("part_row"))
    return counts.join(totals, split).withColumn(
        "share", F.try_divide(F.col("cnt").cast("double"), F.col("part_row").cast("double"))
    )
