import math
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainflow import FeatureSpec, RunPaths
from trainflow.operators.splits import with_split
from trainflow.operators.stages import ConstantFiller, ElapsedDays, FrequencyEncoder, ModeImputer
from trainflow.plans import features, flow, scoring
from trainflow.plans.evaluation import evaluate
from trainflow.plans.training import fit_labels
from trainflow.sources.registry import ModelRegistry
from trainflow.sources.watermark import next_span
from trainflow.streaming import stream_score

SPEC = FeatureSpec(
    target="y",
    key=("id",),
    categorical=("c", "d"),
    numeric=("n",),
    date_pairs=(("sent", "got", "days"),),
    text="t",
    always_drop=("story",),
)


def cases(spark, rows=240):
    """Label and category go together, with gaps, one wide column and unknown targets."""
    k = F.col("id") % 4
    return spark.range(rows).select(
        "id",
        F.when(F.col("id") % 9 != 0, F.when(k < 2, "red").otherwise("blue")).alias("c"),
        F.concat(F.lit("v"), F.col("id") % 7).alias("d"),
        F.when(F.col("id") % 10 != 3, k.cast("double")).alias("n"),
        F.concat(F.lit("2024-01-0"), (k + 1).cast("string"), F.lit(" 00:00:00")).alias("sent"),
        F.when(F.col("id") % 11 != 0, F.lit("2024-01-10 12:00:00")).otherwise(F.lit("later")).alias("got"),
        F.when(F.col("id") % 13 != 0, F.when(k < 2, "late fee").otherwise("lost card")).alias("t"),
        F.when(F.col("id") % 15 == 0, "N/A").when(k < 2, "Yes").otherwise("No").alias("y"),
        F.when(F.col("id") % 5 == 0, "rare").alias("mostly_empty"),
        F.lit("long").alias("story"),
    )


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    paths = RunPaths(str(tmp_path_factory.mktemp("flow")), "one")
    return paths, flow.run_training(cases(spark), SPEC, paths, "m", version=1)


def test_elapsed_days(spark):
    """Days and a half, an end before its start, a month's end in a leap year, text that is no moment."""
    rows = [
        ("2024-03-01 06:00:00", "2024-03-04 18:00:00"),
        ("2024-05-10 00:00:00", "2024-05-08 12:00:00"),
        ("2024-02-28 00:00:00", "2024-03-01 00:00:00"),
        ("soon", "2024-01-01"),
    ]
    df = spark.createDataFrame(rows, "a string, b string")
    out = ElapsedDays(inputCols=["a", "b"], outputCols=["d"]).transform(df).collect()
    assert [r.d for r in out] == [pytest.approx(3.5), pytest.approx(1.5), pytest.approx(2.0), None]
    assert out[3].a is None and out[3].b is not None


def test_stages_survive_saving(spark, tmp_path):
    df = spark.createDataFrame([("x", "a", "u"), ("x", None, None), (None, "b", None)], "p string, q string, r string")
    stages = [
        ConstantFiller(inputCols=["p"], outputCols=["pf"], values=["-"]),
        ModeImputer(inputCols=["p", "q", "r"], outputCols=["im_p", "im_q", "im_r"]),
        FrequencyEncoder(inputCols=["p", "im_q"], outputCols=["fp", "fq"]),
    ]
    model = Pipeline(stages=stages).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    new = spark.createDataFrame([("x", "zz", None), ("new", None, None)], df.schema)
    expected = [("x", "zz", None, "x", "x", "zz", "u", 2.0, 0.0), ("new", None, None, "new", "new", "a", "u", 0.0, 2.0)]
    for one in (model, loaded):
        assert sorted(map(tuple, one.transform(new).collect()), reverse=True) == sorted(expected, reverse=True)
    Pipeline(stages=stages).write().overwrite().save(str(tmp_path / "p"))
    again = Pipeline.load(str(tmp_path / "p"))
    assert [type(s) for s in again.getStages()] == [type(s) for s in stages]


def test_a_column_without_values_keeps_its_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "p string")
    model = ModeImputer(inputCols=["p"], outputCols=["q"]).fit(df)
    assert model.getModes() == [None]
    assert [r.q for r in model.transform(df).collect()] == [None, None]


def test_frequency_stage_can_drop_unknown_rows(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "p string")
    model = FrequencyEncoder(inputCols=["p"], outputCols=["f"], how="inner").fit(df)
    assert [tuple(r) for r in model.transform(df).collect()] == [("x", 2.0)] * 2


def test_setters_set_the_lists(spark):
    imputer = ModeImputer().setInputCols(["a"]).setOutputCols(["b"])
    assert (imputer.getInputCols(), imputer.getOutputCols()) == (["a"], ["b"])


def test_features_are_free_of_nulls_and_unseen_values(spark):
    train = cases(spark).withColumn("empty", F.lit(None).cast("double")).withColumn("same", F.lit("one"))
    spec = FeatureSpec(
        target="y", key=("id",), categorical=("c", "d", "same"), numeric=("n", "empty"), date_pairs=SPEC.date_pairs, text="t"
    )
    model = features.fit_features(train, spec)
    new = train.limit(2).withColumns({"c": F.lit("unseen"), "t": F.lit(None).cast("string"), "d": F.lit(None).cast("string")})
    width = {len(r[spec.features]) for r in model.transform(new).collect()}
    # one slot per seen value (2, 7, 1), two numbers and elapsed days, hashed words
    assert width == {2 + 7 + 1 + 3 + spec.text_slots}
    report = features.stage_report(spark, model)
    assert report.where("stage = 'ModeImputerModel' AND param = 'modes'").first().value == "['blue', 'v0', 'one']"


def test_storing_word_counts_gives_the_same_vectors(spark, tmp_path):
    marked = with_split(cases(spark), ["id"], 30)
    plain = features.fit_features(marked.where("split = 'train'"), SPEC)
    expected = {r.id: r[SPEC.features].toArray().tolist() for r in plain.transform(marked).collect()}
    model, vectors = features.fit_and_store(marked, SPEC, "split", "train", str(tmp_path / "v"))
    assert vectors.columns == ["id", SPEC.features, "y", "split"]
    for rows in (vectors, model.transform(marked)):
        found = {r.id: r[SPEC.features].toArray().tolist() for r in rows.collect()}
        assert found.keys() == expected.keys()
        assert all(found[k] == pytest.approx(expected[k]) for k in expected)


def test_ingest_moves_the_watermark(spark, tmp_path):
    paths = RunPaths(str(tmp_path), "one")
    record = T.StructType([T.StructField("id", T.LongType())])
    landed = tmp_path / "runs" / "one" / "landing"
    landed.mkdir(parents=True)
    (landed / "a.json").write_text('[{"_source": {"id": 1}}, {"_source": {"id": 2}}, {"x": 1}]')
    span = next_span(spark, paths.watermarks, end=date(2024, 1, 1))
    assert sorted(r.id for r in flow.ingest(spark, record, span, paths, enveloped=True).collect()) == [1, 2]
    again = next_span(spark, paths.watermarks, end=date(2024, 1, 1))
    assert again.empty and flow.ingest(spark, record, again, paths) is None
    second = RunPaths(str(tmp_path), "two")
    landed = tmp_path / "runs" / "two" / "landing"
    landed.mkdir(parents=True)
    (landed / "b.json").write_text('{"id": 3}\n{"id"')
    more = flow.ingest(spark, record, next_span(spark, paths.watermarks, end=date(2024, 2, 1)), second)
    assert sorted(r.id for r in more.collect()) == [1, 2, 3]


def test_wide_columns_are_an_error_and_frequency_columns_are_counted(spark):
    spec = FeatureSpec(target="y", key=("id",), categorical=("c", "d"), max_categories=4)
    with pytest.raises(ValueError, match="'d': 7"):
        features.fit_features(cases(spark), spec)
    model = features.fit_features(cases(spark), replace(spec, categorical=("c",), frequency=("d",)))
    row = model.transform(cases(spark)).where("d = 'v1'").first()
    assert row.fe_d == cases(spark).where("d = 'v1'").count()


def test_features_are_learnt_in_two_scans(spark):
    """The learnt stages equal those that Spark ML fits one by one."""
    train = cases(spark)
    first = features.learnt_stages(SPEC, features.profile_features(train, SPEC))
    plain = Pipeline(stages=features.column_stages(SPEC)).fit(train)
    a, b = (PipelineModel(stages=list(s)).transform(train).select(*SPEC.vector_inputs[:-1]).collect() for s in (first, plain.stages))
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_a_wide_target_is_an_error_before_it_is_collected(spark):
    spec = replace(SPEC, max_categories=3)
    df = spark.createDataFrame([(f"k{i}",) for i in range(4)], "y string")
    with pytest.raises(ValueError, match="4 classes"):
        fit_labels(df, spec)


def test_a_run_leaves_no_tables_in_the_shared_folder(spark, tmp_path, jobs):
    """Also counts the jobs of the stages that learn features."""
    shared = Path(spark.conf.get("spark.checkpoint.dir")) / "trainflow"
    before = set(shared.iterdir()) if shared.exists() else set()
    flow.run_training(cases(spark), SPEC, RunPaths(str(tmp_path), "r"))
    assert set(shared.iterdir()) == before
    profile = features.profile_features(cases(spark), SPEC)
    assert jobs(lambda: features.learnt_stages(SPEC, profile), "learnt") <= 2
    assert jobs(lambda: features.profile_features(cases(spark), SPEC), "profile") <= 10  # two scans; each shuffle is a job of its own


def test_a_class_only_the_test_part_has_counts(spark, tmp_path):
    df = cases(spark)
    marked = with_split(df, SPEC.key, SPEC.test_percent)
    third = marked.withColumn("y", F.when((F.col("split") == "test") & (F.col("id") % 2 == 0), "third").otherwise(F.col("y")))
    report = flow.run_training(third.drop("split"), SPEC, RunPaths(str(tmp_path), "r"))
    assert report.metrics["test"]["f1"] == pytest.approx(report.verdict.f1_challenger)
    assert report.metrics["test"]["f1"] < 0.9


def test_a_category_without_values_is_an_error(spark):
    df = cases(spark).withColumn("c", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="'c'"):
        features.fit_features(df, SPEC)


def test_one_class_is_an_error(spark):
    with pytest.raises(ValueError, match="two classes"):
        fit_labels(spark.createDataFrame([("N/A",), ("N/A",)], "y string"), SPEC)


def test_validation_keeps_every_row_somewhere(spark, trained):
    paths, report = trained
    assert report.dropped_columns == ["mostly_empty", "story"]
    good, bad = flow.accepted(spark, paths), flow.rejected(spark, paths)
    assert good.count() + bad.count() == 240
    assert {r.y for r in bad.collect()} == {"N/A"} and bad.where("error_msg IS NULL").isEmpty()
    columns = spark.read.parquet(paths.rejected_columns)
    assert columns.columns == ["id", "mostly_empty", "story", "error_msg"] and columns.count() == 240


def test_training_report(spark, trained):
    paths, report = trained
    assert set(report.metrics) == {"train", "test"}
    assert report.metrics["train"]["f1"] > 0.9
    assert report.verdict.accepted and report.verdict.changed_accuracy == 0.0 and report.verdict.f1_champion is None
    assert report.registered_path == paths.trained_model


def test_missing_required_column_stops_the_run(spark, tmp_path):
    with pytest.raises(ValueError, match="'t'"):
        flow.run_training(cases(spark).drop("t"), SPEC, RunPaths(str(tmp_path), "r"))


def test_saved_model_scores_like_the_fitted_one(spark, trained):
    paths, _ = trained
    registry = ModelRegistry(spark, paths.registry, paths.saved_models)
    model = registry.load_newest("m")
    assert registry.load_newest("m") is model
    out = scoring.predictions(model, cases(spark), SPEC, ["id"])
    assert out.columns == ["id", "c", "d", "n", "t", "sent", "got", "prediction_y"]
    assert out.count() == 240 and {r.prediction_y for r in out.collect()} == {"Yes", "No"}
    first = {r.id: r.prediction_y for r in out.collect()}
    again = scoring.predictions(PipelineModel.load(paths.trained_model), cases(spark), SPEC, ["id"])
    assert {r.id: r.prediction_y for r in again.collect()} == first


def test_second_run_without_gain_is_recorded_but_not_registered(spark, trained):
    first, _ = trained
    paths = RunPaths(first.root, "two")
    report = flow.run_training(cases(spark), SPEC, paths, "m", version=2)
    assert not report.verdict.accepted and report.verdict.changed_accuracy == 0.0
    registry = ModelRegistry(spark, paths.registry, paths.saved_models)
    assert [r.version for r in registry.versions("m").collect()] == [1]
    assert spark.read.parquet(paths.evaluations).count() == 2


def test_registry_orders_versions_by_number(spark, trained, tmp_path):
    paths, _ = trained
    model = PipelineModel.load(paths.trained_model)
    registry = ModelRegistry(spark, str(tmp_path / "r"), str(tmp_path / "m"))
    assert not registry.available("k") and registry.newest_path("k") is None
    with pytest.raises(LookupError):
        registry.load_newest("k")
    registry.list_saved("nine", "k", version=9)
    path = registry.register(model, "k", 0.5, version=10)
    registry.list_saved("other", "z", version=99)
    assert registry.available("k") and registry.newest_path("k") == path
    assert {r.model_key: r.version for r in registry.newest_versions().collect()} == {"k": 10, "z": 99}
    assert len(registry.load_newest("k").stages) == len(model.stages)


def test_batch_scoring_sets_invalid_inputs_aside(spark, trained, tmp_path):
    first, _ = trained
    paths = RunPaths(first.root, "scoring")
    cases(spark).where("id < 100").drop("y").write.parquet(str(tmp_path / "a"))
    cases(spark).where("id >= 100").write.parquet(str(tmp_path / "b"))
    cases(spark).drop("t", "c").write.parquet(str(tmp_path / "c"))
    registry = ModelRegistry(spark, paths.registry, paths.saved_models)
    inputs = [str(tmp_path / name) for name in "abc"]
    report = scoring.score_files(spark, SPEC, registry, "m", inputs, paths)
    assert report.valid == inputs[:2] and report.invalid == {inputs[2]: ["c", "t"]}
    out = spark.read.parquet(report.predictions)
    assert out.count() == 240 and out.where("prediction_y IS NULL").isEmpty()
    assert out.select("source_file").distinct().count() >= 2
    assert spark.read.parquet(paths.archive).count() == 240
    failed = spark.read.parquet(f"{paths.failed}/0")
    assert failed.count() == 240 and failed.first().error_msg == "Missing columns: ['c', 't']"
    none = scoring.score_files(spark, SPEC, registry, "m", inputs[2:], RunPaths(first.root, "none"))
    assert none.predictions is None


def test_streamed_rows_are_scored_once(spark, trained, tmp_path):
    paths, _ = trained
    model = PipelineModel.load(paths.trained_model)
    arriving, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for low, high in ((0, 50), (50, 60)):
        cases(spark).where(f"id >= {low} AND id < {high}").write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(cases(spark).schema).parquet(arriving)
        stream_score(model, stream, SPEC, output, checkpoint, ["id"]).awaitTermination()
    expected = {r.id: r.prediction_y for r in scoring.predictions(model, cases(spark), SPEC, ["id"]).collect()}
    found = spark.read.parquet(output).collect()
    assert len(found) == 60 and {r.id: r.prediction_y for r in found} == {k: expected[k] for k in range(60)}


def test_held_out_rows_without_target_are_an_error(spark, trained):
    paths, _ = trained
    model = PipelineModel.load(paths.trained_model)
    with pytest.raises(ValueError, match="held-out"):
        evaluate(cases(spark).limit(0), SPEC, model, None, 0.002)


def test_weight_of_words_matches_the_formula(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a"), (3, "c")], "id int, t string")
    spec = FeatureSpec(target="y", key=("id",), text="t", text_slots=1 << 18)
    model = features.fit_features(docs, spec)
    weights = {r.id: sorted(r.tf_t.values.tolist()) for r in model.transform(docs).collect()}
    rare, common = math.log(4 / 2), math.log(4 / 3)
    assert weights == {1: pytest.approx([common, rare]), 2: pytest.approx([common]), 3: pytest.approx([rare])}


def test_declared_schema():
    kinds = {f.name: f.dataType.simpleString() for f in SPEC.schema().fields}
    assert kinds["sent"] == "timestamp" and kinds["n"] == "double" and kinds["t"] == "string" and kinds["y"] == "string"


def test_saved_equals_fitted_sees_a_forest_that_changed(spark, monkeypatch):
    from pyspark.ml.feature import IndexToString

    from trainflow.catalog import model as catalog
    from trainflow.sources.registry import ModelRegistry

    folder = "/root/testdata/sf0.001"
    good = catalog.saved_equals_fitted(spark, folder)
    assert good.count() == catalog.cases(spark, folder).count() and good.where("NOT equal").isEmpty()
    load = ModelRegistry.load_newest

    def changed(self, key):
        found = load(self, key)
        names = found.stages[-1]
        assert isinstance(names, IndexToString)
        names.setLabels(names.getLabels()[::-1])
        return found

    monkeypatch.setattr(ModelRegistry, "load_newest", changed)
    assert not catalog.saved_equals_fitted(spark, folder).where("NOT equal").isEmpty()


def test_the_forest_reads_parts_of_bounded_size(spark, monkeypatch):
    from pyspark.ml.linalg import SparseVector

    from trainflow.plans import training

    rows = [(SparseVector(10, [i % 10], [1.0]), float(i % 2), "left out") for i in range(400)]
    df = spark.createDataFrame(rows, [SPEC.features, SPEC.indexed_target, "other"]).coalesce(1)
    assert training.forest_rows(df, SPEC).rdd.getNumPartitions() == 1
    monkeypatch.setattr(training, "PART_CELLS", 500)
    parts = training.forest_rows(df, SPEC)
    assert parts.columns == [SPEC.features, SPEC.indexed_target] and parts.count() == 400
    assert max(map(len, parts.rdd.glom().collect())) * 10 <= 2 * 500


def test_cases_are_joined_once_for_both_trainings(spark, monkeypatch):
    from trainflow.catalog import model as catalog

    asked = []

    class Enough(Exception):
        pass

    def trained(df, *args, **kwargs):
        asked.append(df)
        if len(asked) == 2:
            raise Enough

    made = catalog.cases
    reads = []
    monkeypatch.setattr(catalog, "cases", lambda *a: reads.append(a) or made(*a))
    monkeypatch.setattr(catalog.flow, "run_training", trained)
    with pytest.raises(Enough):
        catalog.retrain_gate(spark, "/root/testdata/sf0.001")
    assert len(reads) == 1 and asked[0].count() == asked[1].count()
