import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from trainflow.operators import gate, metrics
from trainflow.operators.metrics import METRIC_NAMES

FRAMES = {
    "three classes": [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 0.0), (1.0, 1.0), (0.0, 0.0), (2.0, 1.0)],
    "label never predicted": [(0.0, 1.0), (1.0, 1.0), (0.0, 1.0)],
    "prediction never a label": [(0.0, 0.0), (1.0, 2.0), (1.0, 1.0)],
    "label 0 absent": [(1.0, 1.0), (2.0, 1.0)],
    "all wrong": [(0.0, 1.0), (1.0, 0.0)],
}


@pytest.mark.parametrize("name", FRAMES)
def test_metrics_equal_the_evaluators(spark, name):
    df = spark.createDataFrame(FRAMES[name], "label double, prediction double")
    row = metrics.metric_row(metrics.confusion_counts(df, "label", "prediction")).first()
    labels = {a for a, _ in FRAMES[name]}
    for metric in METRIC_NAMES:
        if 0.0 not in labels and metric.endswith("ByLabel"):
            continue  # the evaluator has no such label
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert row[metric] == pytest.approx(evaluator.evaluate(df)), metric


def test_metric_set_has_every_name_and_one_metric_is_a_number(spark):
    df = spark.createDataFrame(FRAMES["three classes"], "label double, prediction double")
    counts = metrics.confusion_counts(df, "label", "prediction")
    assert [r.metric for r in metrics.metric_set(counts).collect()] == list(METRIC_NAMES)
    evaluator = MulticlassClassificationEvaluator(metricName="f1")
    assert metrics.metric(df, "f1", "label", "prediction") == pytest.approx(evaluator.evaluate(df))
    assert metrics.metric(df.limit(0), "f1", "label", "prediction") is None


def test_all_metrics_scan_the_rows_once(spark, jobs):
    df = spark.range(1000).selectExpr("cast(id % 3 as double) AS label", "cast(id % 2 as double) AS prediction")
    few = jobs(lambda: metrics.confusion_counts(df, "label", "prediction").collect(), "confusion")
    all_of_them = jobs(lambda: metrics.metric_row(metrics.confusion_counts(df, "label", "prediction")).collect(), "all")
    assert all_of_them <= few + 3


def test_by_group_and_text_labels(spark):
    df = spark.createDataFrame(
        [("a", "x", "x"), ("a", "y", "x"), ("b", "y", "y"), ("b", None, "y"), ("b", "y", None)], "g string, l string, p string"
    )
    rows = {r.g: r for r in metrics.metric_row(metrics.confusion_counts(df, "l", "p", ["g"]), ["g"], "x").collect()}
    assert rows["a"].precisionByLabel == 0.5 and rows["a"].recallByLabel == 1.0
    assert rows["b"].weightedRecall == 1.0 and rows["b"].recallByLabel == 0.0


def decide(spark, data, **options):
    df = spark.createDataFrame(data, "label string, new string, old string")
    return gate.decide(gate.two_model_counts(df, "label", "new", "old"), 0.002, **options).first()


def test_challenger_must_gain(spark):
    better = [("x", "x", "x"), ("y", "y", "x"), ("x", "x", "x"), ("y", "y", "y")]
    row = decide(spark, better)
    assert row.model_accepted and row.active and row.changed_accuracy == pytest.approx(row.f1_challenger - row.f1_champion)
    same = [("x", "x", "x"), ("y", "x", "x")]
    row = decide(spark, same)
    assert not row.model_accepted and not row.active and row.changed_accuracy == 0.0


def test_floor_for_the_challenger(spark):
    data = [("x", "x", "y"), ("y", "x", "x")]
    assert decide(spark, data).model_accepted
    assert not decide(spark, data, min_f1=0.6).model_accepted


def test_first_model_is_accepted_unchanged(spark):
    df = spark.createDataFrame([("x", "y")], "label string, new string").withColumn("model", F.lit(gate.CHALLENGER))
    row = gate.decide(metrics.confusion_counts(df, "label", "new", ["model"]), 0.002).first()
    assert (row.model_accepted, row.changed_accuracy, row.f1_champion) == (True, 0.0, None)


def test_no_rows_no_verdict(spark):
    counts = gate.two_model_counts(spark.createDataFrame([], "l string, a string, b string"), "l", "a", "b")
    assert gate.decide(counts, 0.002).first() is None
