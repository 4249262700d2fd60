import hashlib
import statistics

import pytest
from pyspark.sql import functions as F

from trainflow.operators import scaling, splits


def bucket(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) % 100


def test_parts_are_complete_disjoint_and_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = splits.train_test(df, ["k"], 30)
    a, b = ({r.k for r in part.collect()} for part in (train, test))
    assert a | b == set(range(2000)) and not a & b
    assert a == {k for k in range(2000) if bucket(k) < 70}
    again, _ = splits.train_test(df.repartition(7), ["k"], 30)
    assert {r.k for r in again.collect()} == a
    marked = splits.with_split(df, ["k"], 30).where(F.col("split") == "train")
    assert {r.k for r in marked.collect()} == a


def test_copies_and_null_keys_stay_together(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), (None, 2), (None, 2)], "a string, b int")
    for key in (["a"], ["a", "b"]):
        marked = splits.with_split(df, key, 50).collect()
        assert marked[0].split == marked[1].split and marked[2].split == marked[3].split
        assert all(r.split for r in marked)


def test_sample_is_a_share_of_the_keys(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    assert splits.key_sample(df, "k", 1_000_000).count() == 20_000
    assert 100 < splits.key_sample(df, "k", 10_000).count() < 300
    assert splits.key_sample(df, "k", 0).count() == 0


def test_balance(spark):
    df = spark.createDataFrame([("train", "a"), ("train", "a"), ("train", "b"), ("test", "b")], "s string, y string")
    found = {(r.s, r.y): (r.cnt, r.part_row) for r in splits.split_balance(df, "s", "y").collect()}
    assert found == {("train", "a"): (2, 3), ("train", "b"): (1, 3), ("test", "b"): (1, 1)}


def test_scaling_by_sample_deviation_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5)], "x double, c int")
    deviations = scaling.deviations(df, ["x", "c"])
    assert deviations == {"x": pytest.approx(statistics.stdev([1, 2, 4])), "c": 0.0}
    scaled = scaling.scale(df, deviations).collect()
    assert [r.scaled_c for r in scaled] == [0.0] * 3
    assert scaled[2].scaled_x == pytest.approx(4 / statistics.stdev([1, 2, 4]))
    assert scaling.deviations(df.limit(1), ["x"]) == {"x": 0.0}
