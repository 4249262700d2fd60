import pytest
from pyspark.sql import functions as F

from trainflow.operators import history
from trainflow.plans.evaluation import EvaluationLog, Verdict


def test_newest_is_by_number_and_keeps_nulls(spark):
    df = spark.createDataFrame([("a", 9, "old"), ("a", 10, None), ("b", 1, "x")], "k string, v long, t string")
    assert {r.k: (r.v, r.t) for r in history.newest(df, ["k"], "v").collect()} == {"a": (10, None), "b": (1, "x")}


def test_deletes_hide_records_until_they_return(spark):
    rows = [(1, 1, False), (1, 2, True), (2, 1, True), (2, 2, None), (3, 1, False)]
    log = spark.createDataFrame(rows, "k int, v int, gone boolean")
    assert sorted(r.k for r in history.current(log, ["k"], "v", "gone").collect()) == [2, 3]
    assert [r.k for r in history.find(log, ["k"], "v", "gone", F.col("k") > 2).collect()] == [3]


def test_evaluation_records(spark, tmp_path):
    log = EvaluationLog(spark, str(tmp_path / "log"))
    with pytest.raises(LookupError):
        log.records()
    log.insert("r1", Verdict(True, 0.0, 0.5, None), "m1")
    log.insert("r2", Verdict(False, -0.1, 0.4, 0.5), "m2", "m1")
    log.insert("r3", Verdict(True, 0.2, 0.7, 0.5), "m3", "m1")
    assert log.records().count() == 3
    assert log.first(F.col("model_accepted")).run_id == "r1"
    log.update(F.col("run_id") == "r1", active=False)
    assert [r.run_id for r in log.records(F.col("active")).collect()] == ["r3"]
    assert log.records(F.col("run_id") == "r1").first().trained_model_path == "m1"
    log.delete_one(F.col("model_accepted"))
    assert {r.run_id for r in log.records().collect()} < {"r1", "r2", "r3"} and log.records().count() == 2
    log.delete(F.lit(True))
    assert log.records().count() == 0 and log.first() is None
    assert log.log().count() == 3 + 1 + 1 + 2
