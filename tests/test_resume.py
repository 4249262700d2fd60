"""Runs that break off and go on, and writers that meet."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from test_workflow import SPEC, cases
from trainflow import RunPaths
from trainflow.plans import flow
from trainflow.plans.evaluation import EvaluationLog, Verdict
from trainflow.sources import watermark
from trainflow.sources.files import Conflict
from trainflow.sources.registry import ModelRegistry
from trainflow.sources.watermark import LoadSpan

STAGES = ["validate", "prepare", "train", "evaluate"]


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    return flow.run_training(cases(spark), SPEC, RunPaths(str(tmp_path_factory.mktemp("whole")), "r"), "m", version=1)


@pytest.mark.parametrize("stage", STAGES)
def test_a_broken_run_does_only_the_rest(spark, tmp_path, monkeypatch, whole, stage):
    paths = RunPaths(str(tmp_path), "r")
    getattr(flow.TrainingRun(cases(spark), SPEC, paths, "m", version=1), stage)()

    def never(*args, **more):
        raise AssertionError("done before")

    work = {"validate": ["validate"], "prepare": ["profile_features", "store_inputs"], "train": ["train"], "evaluate": ["evaluate"]}
    for done in STAGES[: STAGES.index(stage) + 1]:
        for name in work[done]:
            monkeypatch.setattr(flow, name, never)
    report = flow.run_training(cases(spark), SPEC, paths, "m", version=1)
    assert (report.metrics, report.verdict, report.dropped_columns) == (whole.metrics, whole.verdict, whole.dropped_columns)
    assert ModelRegistry(spark, paths.registry, paths.saved_models).versions("m").count() == 1
    again = flow.run_training(cases(spark), SPEC, paths, "m", version=1)
    assert again == report and spark.read.parquet(paths.evaluations).count() == 1


def test_a_stage_that_broke_off_halfway_is_done_again(spark, tmp_path, monkeypatch, whole):
    paths = RunPaths(str(tmp_path), "r")
    enter = flow.TrainingRun._enter
    for broken in ("validate", "prepare", "train", "evaluate"):
        monkeypatch.setattr(flow.TrainingRun, "_enter", lambda self, stage, **found: 1 / 0 if stage == broken else enter(self, stage, **found))
        with pytest.raises(ZeroDivisionError):
            flow.run_training(cases(spark), SPEC, paths, "m", version=1)
        if broken == "validate":
            odd = cases(spark).limit(7).withColumns({"accepted": F.lit("true"), "split": F.lit("old")})
            odd.write.mode("append").partitionBy("accepted", "split").parquet(paths.validated)
    monkeypatch.setattr(flow.TrainingRun, "_enter", enter)
    assert flow.run_training(cases(spark), SPEC, paths, "m", version=1).metrics == whole.metrics


def test_a_run_id_belongs_to_one_input_and_spec(spark, tmp_path):
    paths = RunPaths(str(tmp_path), "r")
    flow.TrainingRun(cases(spark), SPEC, paths).validate()
    with pytest.raises(ValueError, match="another input"):
        flow.TrainingRun(cases(spark, 239), SPEC, paths)
    with pytest.raises(ValueError, match="another input"):
        flow.TrainingRun(cases(spark), SPEC, paths, min_gain=0.5)
    assert flow.fingerprint(cases(spark)) == flow.fingerprint(cases(spark).repartition(7))
    assert flow.fingerprint(cases(spark)) != flow.fingerprint(cases(spark).withColumn("c", F.coalesce("c", F.lit(""))))


def test_registry_versions_are_listed_once(spark, tmp_path):
    registry = [ModelRegistry(spark, str(tmp_path / "r"), str(tmp_path / "m")) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: registry[i % 4].list_saved(f"p{i}", "k"), range(12)))
    assert len(set(numbers)) == 12 and registry[0].versions("k").count() == 12
    registry[0].list_saved("x", "k", version=5)
    with pytest.raises(Conflict):
        registry[1].list_saved("y", "k", version=5)
    registry[1].list_saved("y", "other", version=5)


def test_one_of_two_loads_moves_the_watermark(spark, tmp_path):
    path = str(tmp_path / "w")
    spans = [watermark.next_span(spark, path, end=date(2024, 1, d)) for d in (5, 9)]
    watermark.record_load(spark, path, spans[0], "store")
    with pytest.raises(Conflict):
        watermark.record_load(spark, path, spans[1], "store")
    assert watermark.last_end(spark, path) == date(2024, 1, 5)
    assert watermark.next_span(spark, path, end=date(2024, 1, 9)) == LoadSpan(date(2024, 1, 5), date(2024, 1, 9))


def test_one_of_two_updates_is_refused(spark, tmp_path, monkeypatch):
    log, other = (EvaluationLog(spark, str(tmp_path / "e")) for _ in range(2))
    for run in ("a", "b"):
        log.insert(run, Verdict(True, 0.1, 0.9, 0.8), "path")
    records = EvaluationLog.records

    def meanwhile(self, query=None):
        found = records(self, query)
        if self is log:
            monkeypatch.setattr(EvaluationLog, "records", records)
            other.update(F.col("run_id") == "a", active=False)
        return found

    monkeypatch.setattr(EvaluationLog, "records", meanwhile)
    with pytest.raises(Conflict):
        log.update(F.lit(True), changed_accuracy=0.0)
    assert {(r.run_id, r.active, r.changed_accuracy) for r in log.records().collect()} == {("a", False, 0.1), ("b", True, 0.1)}
    log.update(F.lit(True), changed_accuracy=0.0)
    log.delete_one(F.lit(True))
    assert [(r.run_id, r.changed_accuracy) for r in log.records().collect()] == [("b", 0.0)]
    assert "change" not in log.records().columns


def test_a_repeated_batch_of_scores_replaces_itself(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from test_inputs import SPEC as INPUT_SPEC
    from test_inputs import Echo, table
    from trainflow.plans import scoring
    from trainflow.streaming import stream_score

    model, output = PipelineModel(stages=[Echo()]), str(tmp_path / "out")
    with pytest.raises(LookupError, match="nothing was scored"):
        scoring.read_scores(spark, output)
    for ids in ((1, 2, 3), (1, 2)):
        scoring.score_into(model, table(spark, *ids), INPUT_SPEC, output, "a", ["id"])
    arriving, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for i in (7, 8):
        table(spark, i).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(table(spark, 1).schema).parquet(arriving)
        stream_score(model, stream, INPUT_SPEC, output, checkpoint, ["id"]).awaitTermination()
    assert sorted(r.id for r in scoring.read_scores(spark, output).collect()) == [1, 2, 7, 8]
