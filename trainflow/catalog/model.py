"""Metrics, the acceptance gate, training and scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trainflow.catalog.prepare import digest
from trainflow.catalog.tables import (
    CASE_SPEC,
    CASES,
    DOCUMENT_SPEC,
    cases,
    labelled_documents,
    load,
)
from trainflow.operators import gate, metrics
from trainflow.operators.metrics import METRIC_NAMES
from trainflow.operators.splits import TEST, TRAIN, with_split
from trainflow.operators.stages import FrequencyEncoderModel
from trainflow.plans import features, flow, scoring, training
from trainflow.plans.evaluation import EvaluationLog
from trainflow.sources.registry import ModelRegistry
from trainflow.spec import MIN_F1_GAIN, RunPaths
from trainflow.streaming import stream_score as start_scoring
from trainflow.workspace import new_folder, written

MODEL_KEY = "cases"


def _quality(spark, folder):
    """Quality labels with "not toxic" standing for a prediction of good quality."""
    return load(spark, folder, "labels").select("quality", (F.lit(1) - F.col("toxic")).alias("guess"))


def _orders(spark, folder):
    """Order status guessed from the price (challenger) and from the priority (champion)."""
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    by_price = F.when(price < 200000, "F").when(price < 400000, "O").otherwise("P")
    by_priority = F.when(priority == "1-URGENT", "F").when(priority == "5-LOW", "P").otherwise("O")
    return load(spark, folder, "orders").select(
        "o_orderstatus", by_price.alias("by_price"), by_priority.alias("by_priority")
    )


def _rounded(df):
    return df.withColumn("value", F.round("value", 6))


def confusion_counts(spark, folder):
    return metrics.confusion_counts(_orders(spark, folder), "o_orderstatus", "by_price")


def metric_set(spark, folder):
    return _rounded(metrics.metric_set(metrics.confusion_counts(_quality(spark, folder), "quality", "guess")))


def metric_set_three_classes(spark, folder):
    counts = metrics.confusion_counts(_orders(spark, folder), "o_orderstatus", "by_price")
    return _rounded(metrics.metric_set(counts, by_label="F"))


def metric_set_by_split(spark, folder):
    """Train and test measured in the same pass."""
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_totalprice") < 250000, "F").otherwise("O").alias("guess")
    )
    marked = with_split(orders, ["o_orderkey"], 30)
    counts = metrics.confusion_counts(marked, "o_orderstatus", "guess", by=["split"])
    return _rounded(metrics.metric_set(counts, by=["split"], by_label="O"))


def class_metrics(spark, folder):
    per_class = metrics.class_metrics(metrics.confusion_counts(_orders(spark, folder), "o_orderstatus", "by_priority"))
    rates = ["precision", "recall", "false_positive_rate", "f_measure"]
    return per_class.select("class", "n", "p", "tp", "total", *[F.round(r, 6).alias(r) for r in rates])


def _decided(df):
    rounded = {c: F.round(c, 6) for c in ("f1_challenger", "f1_champion", "changed_accuracy")}
    return df.withColumns(rounded)


def challenger_gate(spark, folder):
    counts = gate.two_model_counts(_orders(spark, folder), "o_orderstatus", "by_price", "by_priority")
    return _decided(gate.decide(counts, MIN_F1_GAIN))


def challenger_gate_with_floor(spark, folder):
    """The same with a lowest F1 the challenger must reach."""
    counts = gate.two_model_counts(_orders(spark, folder), "o_orderstatus", "by_price", "by_priority")
    return _decided(gate.decide(counts, -1.0, min_f1=0.6))


def first_model_gate(spark, folder):
    """No champion yet."""
    only = _orders(spark, folder).withColumn("model", F.lit(gate.CHALLENGER))
    counts = metrics.confusion_counts(only, "o_orderstatus", "by_price", by=["model"])
    return _decided(gate.decide(counts, MIN_F1_GAIN))


def label_index(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    indexer = StringIndexer(inputCol="o_orderstatus", outputCol="label", handleInvalid="skip").fit(orders)
    return indexer.transform(orders).select("o_orderkey", "label")


def label_decode(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    indexer = StringIndexer(inputCol="o_orderstatus", outputCol="label", handleInvalid="skip").fit(orders)
    names = IndexToString(inputCol="label", outputCol="status", labels=indexer.labels)
    return names.transform(indexer.transform(orders)).select("o_orderkey", "status")


def _paths(spark, run_id="first", root=None):
    return RunPaths(root or new_folder(spark, "workflow"), run_id)


def validated_cases(spark, folder):
    """The validation stage: accepted rows with their part."""
    rows, _ = flow.validate(written(cases(spark, folder), "cases"), CASE_SPEC, _paths(spark))
    return rows.select("case_id", "priority", "outcome", "split")


def feature_vectors(spark, folder):
    """Feature vectors of labelled documents, fitted on the train part only.

    Shows the scaled slots of language, source and length; those of the words follow them.
    """
    marked = with_split(
        written(labelled_documents(spark, folder), "documents"), DOCUMENT_SPEC.key, DOCUMENT_SPEC.test_percent
    )
    model = features.fit_features(marked.where(F.col("split") == TRAIN), DOCUMENT_SPEC)
    slots = vector_to_array(DOCUMENT_SPEC.features).alias("slots")
    langs = F.size(vector_to_array("tf_lang")).alias("langs")
    vectors = model.transform(marked).select("doc_id", "split", slots, langs)
    return vectors.select(
        "doc_id",
        "split",
        F.round(F.array_max(F.slice("slots", F.lit(1), F.col("langs"))), 6).alias("lang"),
        F.round(F.col("slots")[F.col("langs")], 6).alias("source"),
        F.round(F.col("slots")[F.col("langs") + 1], 6).alias("length"),
        (F.size("slots") - F.col("langs") - 2).alias("word_slots"),
    )


def stage_report(spark, folder):
    model = features.fit_features(written(labelled_documents(spark, folder), "documents"), DOCUMENT_SPEC)
    return features.stage_report(spark, model)


def _train(spark, folder, paths, version=1):
    """Training reads a stored table, as it does behind an ingest."""
    return flow.run_training(written(cases(spark, folder), "cases"), CASE_SPEC, paths, MODEL_KEY, version=version)


def train_metrics(spark, folder):
    """Whole training run on the case records; all metrics of both parts."""
    report = _train(spark, folder, _paths(spark))
    rows = [(part, name, value) for part, values in report.metrics.items() for name, value in values.items()]
    return spark.createDataFrame(rows, "split string, metric string, value double")


def train_score(spark, folder):
    """Train, register, load the newest version and score every case, without cap."""
    paths = _paths(spark)
    _train(spark, folder, paths)
    model = ModelRegistry(spark, paths.registry, paths.saved_models).load_newest(MODEL_KEY)
    return scoring.predictions(model, cases(spark, folder), CASE_SPEC, CASE_SPEC.key)


def retrain_gate(spark, folder):
    """A second model, trained where most held-out rows have a class turned round, does not replace the first.

    Shows both runs' records with the version that each registered and the rows it was judged on.
    """
    first = _paths(spark)
    stored = written(cases(spark, folder), "cases")
    flow.run_training(stored, CASE_SPEC, first, MODEL_KEY, version=1)
    second = _paths(spark, "second", first.root)
    turned = F.when(F.col("outcome") == "Yes", "No").when(F.col("outcome") == "No", "Yes").otherwise(F.col("outcome"))
    marked = with_split(stored, CASE_SPEC.key, CASE_SPEC.test_percent)
    records = marked.withColumn("outcome", F.when(F.col("split") == TRAIN, turned).otherwise(F.col("outcome")))
    rows = written(records.drop("split"), "cases")
    flow.run_training(rows, CASE_SPEC, second, MODEL_KEY, version=2)
    registry = ModelRegistry(spark, first.registry, first.saved_models)
    log = EvaluationLog(spark, first.evaluations).records()
    listed = registry.versions(MODEL_KEY).select("path", "version")
    judged = flow.accepted(spark, second).where(F.col("split") == TEST).count()
    joined = log.join(listed, log["trained_model_path"] == listed["path"], "left")
    return joined.select("run_id", "model_accepted", "active", "version", F.lit(judged).cast("long").alias("judged"))


def _case_model(spark, folder):
    """A trained model of the case records, and the run's folders."""
    paths = _paths(spark)
    _train(spark, folder, paths)
    return ModelRegistry(spark, paths.registry, paths.saved_models).load_newest(MODEL_KEY), paths


def score_coverage(spark, folder):
    """Every case once, with one of the classes that cases have."""
    model, _ = _case_model(spark, folder)
    scored = scoring.predictions(model, cases(spark, folder), CASE_SPEC, CASE_SPEC.key)
    known = F.col(CASE_SPEC.predicted_target).isin("Yes", "No")
    return scored.groupBy("case_id").agg(F.count(F.lit(1)).alias("times"), F.bool_and(known).alias("known"))


def metrics_crosscheck(spark, folder):
    """Metrics of the held-out cases beside those of Spark's own evaluator, for the class of the first label."""
    model, paths = _case_model(spark, folder)
    held_out = flow.accepted(spark, paths).where(F.col("split") == TEST)
    indexer = StringIndexerModel.load(paths.label_indexer)
    scored = written(indexer.transform(model.transform(held_out)).select(CASE_SPEC.indexed_target, "prediction"), "scored")
    counts = metrics.confusion_counts(scored, CASE_SPEC.indexed_target, "prediction")
    own = metrics.metric_row(counts).first()
    evaluator = MulticlassClassificationEvaluator(labelCol=CASE_SPEC.indexed_target, metricLabel=0.0)
    rows = [(m, abs(evaluator.setMetricName(m).evaluate(scored) - own[m]) < 1e-9) for m in METRIC_NAMES]
    return spark.createDataFrame(rows, "metric string, equal boolean").withColumn("rows", F.lit(scored.count()).cast("long"))


def saved_equals_fitted(spark, folder):
    """A fitted scoring model and the same one listed, saved and loaded: are every case's vector and prediction equal?"""
    rows = written(cases(spark, folder), "cases")
    fitted = features.fit_features(rows, CASE_SPEC)
    prepared = written(fitted.transform(rows), "prepared")
    labels = training.fit_labels(prepared, CASE_SPEC)
    classifier = training.fit_classifier(labels.transform(prepared), CASE_SPEC, labels)
    model = training.scoring_model(fitted, classifier)
    root = new_folder(spark, "model")
    labels.write().save(f"{root}/labels")
    same = StringIndexerModel.load(f"{root}/labels").labels == labels.labels
    registry = ModelRegistry(spark, f"{root}/registry", f"{root}/models")
    registry.register(model, MODEL_KEY)
    found = _same_scores(model, registry.load_newest(MODEL_KEY), rows)
    return found.withColumn("equal", F.col("equal") & F.lit(same))


def _same_scores(fitted, loaded, rows):
    """For each case, whether two scoring models give the same vector, probabilities, prediction and class."""
    names = [CASE_SPEC.features, "probability", "prediction", CASE_SPEC.predicted_target]

    def scored(model):
        found = model.transform(rows)
        # Of the many slots of a case only those that hold something: the same comparison, on much less.
        slots = F.transform(vector_to_array(names[0]), lambda x, i: F.when(x != 0, F.struct(i.alias("i"), x.alias("x"))))
        filled = F.struct(F.size(vector_to_array(names[0])).alias("n"), F.array_compact(slots).alias("slots"))
        vectors = {names[0]: filled, names[1]: vector_to_array(names[1])}
        return found.withColumns(vectors).select("case_id", F.struct(*names).alias("all"))

    first = scored(fitted)
    second = scored(loaded).select(F.col("case_id").alias("k"), F.col("all").alias("other"))
    # The stored rows are small, their scores are not: never broadcast by the size of the rows.
    joined = first.hint("merge").join(second, F.col("case_id") == F.col("k"))
    return joined.select("case_id", F.col("all").eqNullSafe(F.col("other")).alias("equal"))


def stream_equals_batch(spark, folder):
    """Cases scored as a stream of files and as one table: is every prediction equal?"""
    model, _ = _case_model(spark, folder)
    arriving, output, checkpoint = (new_folder(spark, n) for n in ("arriving", "scored", "stream"))
    cases(spark, folder).write.parquet(arriving)
    stream = spark.readStream.schema(spark.read.parquet(arriving).schema).parquet(arriving)
    start_scoring(model, stream, CASE_SPEC, output, checkpoint, CASE_SPEC.key).awaitTermination()
    name = CASE_SPEC.predicted_target
    streamed = spark.read.parquet(output).select(F.col("case_id").alias("k"), F.col(name).alias("b"))
    batch = scoring.predictions(model, spark.read.parquet(arriving), CASE_SPEC, CASE_SPEC.key)
    joined = batch.join(streamed, F.col("case_id") == F.col("k"), "full")
    return joined.select(F.coalesce("case_id", "k").alias("case_id"), F.col(name).eqNullSafe(F.col("b")).alias("equal"))


def batch_score_inputs(spark, folder):
    """Three input folders: one good, one with good and old files, one with a file that is no table."""
    _, paths = _case_model(spark, folder)
    registry = ModelRegistry(spark, paths.registry, paths.saved_models)
    rows = written(cases(spark, folder).drop("sparse_note"), "cases")
    good, mixed, broken = (f"{paths.root}/input/{n}" for n in ("good", "mixed", "broken"))
    rows.where("outcome = 'Yes'").write.parquet(good)
    rows.where("outcome = 'No'").write.parquet(mixed)
    rows.where("outcome = 'N/A'").drop("segment").write.mode("append").parquet(mixed)
    load(spark, folder, "region").select("r_name").coalesce(1).write.text(broken)
    report = scoring.score_files(spark, CASE_SPEC, registry, MODEL_KEY, [good, mixed, broken], paths)
    scored = spark.read.parquet(report.predictions).select(F.regexp_extract("source_file", "/input/([a-z]+)/", 1).alias("place"))
    failed = spark.read.parquet(f"{paths.failed}/0").select(F.col("error_msg").alias("place"))
    unread = spark.read.parquet(f"{paths.failed}/unreadable").select(F.regexp_extract("path", "/input/([a-z]+)/", 1).alias("place"))
    return scored.unionByName(failed).unionByName(unread).groupBy("place").agg(F.count(F.lit(1)).alias("n_rows"))


def _document_model(spark, folder):
    """A model of the labelled documents, whose counts of sources are taken as too many to broadcast."""
    paths = _paths(spark)
    flow.run_training(written(labelled_documents(spark, folder), "documents"), DOCUMENT_SPEC, paths, "documents", version=1)
    model = ModelRegistry(spark, paths.registry, paths.saved_models).load_newest("documents")
    for stage in model.stages:
        if isinstance(stage, FrequencyEncoderModel):
            stage.setSizes([[1 << 40, 1 << 40] for _ in stage.getInputCols()])
    return model


def stream_score_wide_frequency(spark, folder):
    """Documents scored as a stream with a shuffled lookup of frequencies, beside one table: are they equal?"""
    model = _document_model(spark, folder)
    arriving, output, checkpoint = (new_folder(spark, n) for n in ("arriving", "scored", "stream"))
    load(spark, folder, "documents").write.parquet(arriving)
    stream = spark.readStream.schema(spark.read.parquet(arriving).schema).parquet(arriving)
    start_scoring(model, stream, DOCUMENT_SPEC, output, checkpoint, ["doc_id"]).awaitTermination()
    name = DOCUMENT_SPEC.predicted_target
    streamed = scoring.read_scores(spark, output).select(F.col("doc_id").alias("k"), F.col(name).alias("b"))
    batch = scoring.predictions(model, spark.read.parquet(arriving), DOCUMENT_SPEC, ["doc_id"])
    joined = batch.join(streamed, F.col("doc_id") == F.col("k"), "full")
    return joined.select(F.coalesce("doc_id", "k").alias("doc_id"), F.col(name).eqNullSafe(F.col("b")).alias("equal"))


def scores_in_one_store(spark, folder):
    """Old cases scored by a batch job that is repeated, new ones by a stream, into one store."""
    model, _ = _case_model(spark, folder)
    output, arriving, checkpoint = (new_folder(spark, n) for n in ("scored", "arriving", "stream"))
    rows = written(cases(spark, folder), "cases")
    for _ in range(2):
        scoring.score_into(model, rows.where("outcome <> 'No'"), CASE_SPEC, output, "old", CASE_SPEC.key)
    rows.where("outcome = 'No'").write.parquet(arriving)
    stream = spark.readStream.schema(rows.schema).parquet(arriving)
    start_scoring(model, stream, CASE_SPEC, output, checkpoint, CASE_SPEC.key).awaitTermination()
    return scoring.read_scores(spark, output).groupBy("case_id").agg(F.count(F.lit(1)).alias("times"))


def resumed_run(spark, folder):
    """A run that broke off after its features were prepared, started again, beside one that went through:
    is every case's prediction equal?"""
    rows = written(cases(spark, folder), "cases")
    whole, broken = _paths(spark), _paths(spark)
    flow.run_training(rows, CASE_SPEC, whole, MODEL_KEY, version=1)
    flow.TrainingRun(rows, CASE_SPEC, broken, MODEL_KEY, version=1).prepare()
    flow.run_training(rows, CASE_SPEC, broken, MODEL_KEY, version=1)
    name = CASE_SPEC.predicted_target

    def scored(paths, column):
        model = ModelRegistry(spark, paths.registry, paths.saved_models).load_newest(MODEL_KEY)
        return scoring.predictions(model, rows, CASE_SPEC, CASE_SPEC.key).select(F.col("case_id").alias(column), F.col(name).alias(f"{column}_class"))

    both = scored(whole, "case_id").join(scored(broken, "other"), F.col("case_id") == F.col("other"))
    return both.select("case_id", F.col("case_id_class").eqNullSafe(F.col("other_class")).alias("equal"))


def batch_score_types(spark, folder):
    """Files of one input that hold keys, dates and texts in other types, and one whose types do not fit.

    Every case with the kind of its file, and whether its prediction is that of the cases as one table.
    """
    model, paths = _case_model(spark, folder)
    registry = ModelRegistry(spark, paths.registry, paths.saved_models)
    rows, place = written(cases(spark, folder).drop("sparse_note"), "cases"), f"{paths.root}/input"
    texts = {c: F.col(c).cast("string") for c in ("case_id", "opened_at")} | {"sent_at": F.col("sent_at").cast("timestamp")}
    rows.where("outcome = 'Yes'").write.parquet(f"{place}/plain")
    rows.where("outcome = 'No'").withColumns(texts).write.parquet(f"{place}/texts")
    rows.where("outcome = 'N/A'").withColumn("channel", F.array("channel")).write.parquet(f"{place}/unfit")
    report = scoring.score_files(spark, CASE_SPEC, registry, MODEL_KEY, [place], paths)
    name = CASE_SPEC.predicted_target
    kind = F.regexp_extract("source_file", "/input/([a-z]+)/", 1).alias("place")
    found = spark.read.parquet(report.predictions).select(F.col("case_id").cast("long").alias("k"), kind, F.col(name).alias("other"))
    one = scoring.predictions(model, rows, CASE_SPEC, CASE_SPEC.key)
    scored = one.join(found, F.col("case_id") == F.col("k")).select("case_id", "place", F.col(name).eqNullSafe(F.col("other")).alias("equal"))
    failed = spark.read.parquet(f"{paths.failed}/0").select("case_id", F.col("error_msg").alias("place"), F.lit(None).cast("boolean").alias("equal"))
    return scored.unionByName(failed)


def batch_score_absent_input(spark, folder):
    """One input that is there and one that is not: what the report says, and how many rows were scored."""
    _, paths = _case_model(spark, folder)
    registry = ModelRegistry(spark, paths.registry, paths.saved_models)
    here, gone = (f"{paths.root}/input/{n}" for n in ("here", "gone"))
    cases(spark, folder).write.parquet(here)
    report = scoring.score_files(spark, CASE_SPEC, registry, MODEL_KEY, [gone, here], paths)
    rows = [(p.rpartition("/")[2], p in report.valid, len(report.invalid.get(p, []))) for p in (here, gone)]
    judged = spark.createDataFrame(rows, "input string, valid boolean, n_missing int")
    source = F.regexp_extract("source_file", "/input/([a-z]+)/", 1).alias("input")
    counts = spark.read.parquet(report.predictions).groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"))
    return judged.join(counts, "input", "left").select("input", "valid", "n_missing", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def unlabelled_documents_scored(spark, folder):
    """Documents without a label, scored with the model of the labelled ones."""
    paths = _paths(spark)
    documents = written(labelled_documents(spark, folder), "documents")
    flow.run_training(documents, DOCUMENT_SPEC, paths, "documents", version=1)
    model = ModelRegistry(spark, paths.registry, paths.saved_models).load_newest("documents")
    others = load(spark, folder, "documents").join(load(spark, folder, "labels"), "doc_id", "left_anti")
    scored = scoring.score(model, others).select("doc_id", F.col(DOCUMENT_SPEC.predicted_target).isin("0", "1").alias("known"))
    return scored


def document_metrics(spark, folder):
    """Training on whole texts with quality as target."""
    documents = written(labelled_documents(spark, folder), "documents")
    report = flow.run_training(documents, DOCUMENT_SPEC, _paths(spark), "documents", version=1)
    rows = [(part, name, value) for part, values in report.metrics.items() for name, value in values.items()]
    return spark.createDataFrame(rows, "split string, metric string, value double")


def _case_files(spark, folder, root):
    """Scoring inputs: one table per order status, and one without the needed columns."""
    records = cases(spark, folder).drop("outcome", "sparse_note")
    records.write.parquet(f"{root}/input/cases")
    load(spark, folder, "customer").write.parquet(f"{root}/input/other")
    return [f"{root}/input/cases", f"{root}/input/other"]


def batch_score(spark, folder):
    """Score input folders as one table; the folder without the columns is set aside."""
    paths = _paths(spark)
    _train(spark, folder, paths)
    registry = ModelRegistry(spark, paths.registry, paths.saved_models)
    inputs = _case_files(spark, folder, paths.root)
    scoring.score_files(spark, CASE_SPEC, registry, MODEL_KEY, inputs, paths)
    return spark.read.parquet(paths.predictions).select("case_id", "priority", CASE_SPEC.predicted_target)


def batch_score_archive(spark, folder):
    """What batch scoring left behind: archived input rows and rows set aside with a reason."""
    paths = _paths(spark)
    _train(spark, folder, paths)
    registry = ModelRegistry(spark, paths.registry, paths.saved_models)
    inputs = _case_files(spark, folder, paths.root)
    scoring.score_files(spark, CASE_SPEC, registry, MODEL_KEY, inputs, paths)
    archived = spark.read.parquet(paths.archive).selectExpr("'archive' AS place", "case_id AS id")
    failed = spark.read.parquet(f"{paths.failed}/0").selectExpr("'failed' AS place", "c_custkey AS id")
    return archived.unionByName(failed)


def stream_score(spark, folder):
    """The case records scored as a stream of files, with the model of a training run."""
    paths = _paths(spark)
    _train(spark, folder, paths)
    model = ModelRegistry(spark, paths.registry, paths.saved_models).load_newest(MODEL_KEY)
    arriving, output, checkpoint = (new_folder(spark, n) for n in ("arriving", "scored", "stream"))
    cases(spark, folder).write.parquet(arriving)
    schema = spark.read.parquet(arriving).schema
    stream = spark.readStream.schema(schema).parquet(arriving)
    start_scoring(model, stream, CASE_SPEC, output, checkpoint, CASE_SPEC.key).awaitTermination()
    return spark.read.parquet(output).select("case_id", "priority", CASE_SPEC.predicted_target)


def held_out_cases(spark, folder):
    """Rows the gate may look at: known target, test part."""
    rows, _ = flow.validate(written(cases(spark, folder), "cases"), CASE_SPEC, _paths(spark))
    return rows.where(F.col("split") == TEST).select("case_id", "outcome")


QUERIES = {
    "confusion_counts": confusion_counts,
    "metric_set": metric_set,
    "metric_set_three_classes": metric_set_three_classes,
    "metric_set_by_split": metric_set_by_split,
    "class_metrics": class_metrics,
    "challenger_gate": challenger_gate,
    "challenger_gate_with_floor": challenger_gate_with_floor,
    "first_model_gate": first_model_gate,
    "label_index": label_index,
    "label_decode": label_decode,
    "validated_cases": validated_cases,
    "held_out_cases": held_out_cases,
    "feature_vectors": feature_vectors,
    "stage_report": stage_report,
    "train_metrics": train_metrics,
    "train_score": train_score,
    "retrain_gate": retrain_gate,
    "document_metrics": document_metrics,
    "batch_score": batch_score,
    "batch_score_archive": batch_score_archive,
    "stream_score": stream_score,
    "score_coverage": score_coverage,
    "metrics_crosscheck": metrics_crosscheck,
    "saved_equals_fitted": saved_equals_fitted,
    "stream_equals_batch": stream_equals_batch,
    "batch_score_inputs": batch_score_inputs,
    "stream_score_wide_frequency": stream_score_wide_frequency,
    "scores_in_one_store": scores_in_one_store,
    "resumed_run": resumed_run,
    "batch_score_types": batch_score_types,
    "batch_score_absent_input": batch_score_absent_input,
    "unlabelled_documents_scored": unlabelled_documents_scored,
}

_QUALITY = "SELECT quality AS label, 1 - toxic AS prediction FROM labels"
_BY_PRICE = "CASE WHEN o_totalprice < 200000 THEN 'F' WHEN o_totalprice < 400000 THEN 'O' ELSE 'P' END"
_BY_PRIORITY = "CASE o_orderpriority WHEN '1-URGENT' THEN 'F' WHEN '5-LOW' THEN 'P' ELSE 'O' END"
_SPLIT = f"CASE WHEN {digest('o_orderkey', 100)} < 70 THEN 'train' ELSE 'test' END"


def _rates(scored: str, by: str = "") -> str:
    """Per-class rates of scored rows (``by`` columns end with a comma)."""
    part = f"PARTITION BY {by.rstrip(', ')}" if by else ""
    return f"""scored AS ({scored}),
    cm AS (SELECT {by} label, prediction, count(*) AS cnt FROM scored GROUP BY ALL),
    sides AS (SELECT {by} label AS class, cnt AS n, 0 AS p,
                     CASE WHEN label = prediction THEN cnt ELSE 0 END AS tp FROM cm
              UNION ALL SELECT {by} prediction, 0, cnt, 0 FROM cm),
    cls AS (SELECT {by} class, sum(n)::DOUBLE AS n, sum(p)::DOUBLE AS p, sum(tp)::DOUBLE AS tp FROM sides GROUP BY ALL),
    tot AS (SELECT *, sum(n) OVER ({part}) AS total FROM cls),
    pr AS (SELECT *, CASE WHEN p = 0 THEN 0 ELSE tp / p END AS prec, CASE WHEN n = 0 THEN 0 ELSE tp / n END AS rec,
                  CASE WHEN total = n THEN 0 ELSE (p - tp) / (total - n) END AS fpr FROM tot),
    rates AS (SELECT *, CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END AS f FROM pr)"""


def _metric_sql(scored: str, label: str, by: str = "") -> str:
    value = {"f1": "f", "weightedPrecision": "prec", "weightedRecall": "rec", "weightedTruePositiveRate": "rec"}
    value |= {"weightedFalsePositiveRate": "fpr", "weightedFMeasure": "f", "truePositiveRateByLabel": "rec"}
    value |= {"falsePositiveRateByLabel": "fpr", "precisionByLabel": "prec", "recallByLabel": "rec"}
    value |= {"fMeasureByLabel": "f"}

    def one(name):
        rate = value[name]
        by_label = f"sum(CASE WHEN class = {label} THEN {rate} ELSE 0 END)"
        total = by_label if "ByLabel" in name else f"sum({rate} * n / total)"
        return f"SELECT {by} '{name}' AS metric, round({total}, 6)::DOUBLE AS value FROM rates GROUP BY ALL"

    return f"WITH {_rates(scored, by)} " + " UNION ALL ".join(one(name) for name in METRIC_NAMES)


_BOTH = f"""SELECT 'challenger' AS model, o_orderstatus AS label, {_BY_PRICE} AS prediction FROM orders
    UNION ALL SELECT 'champion', o_orderstatus, {_BY_PRIORITY} FROM orders"""
_FIRST = f"SELECT 'challenger' AS model, o_orderstatus AS label, {_BY_PRICE} AS prediction FROM orders"


def _gate_sql(scored: str, accepted: str) -> str:
    return f"""WITH {_rates(scored, "model, ")},
    f1 AS (SELECT model, sum(f * n / total) AS f1 FROM rates GROUP BY 1),
    pair AS (SELECT max(f1) FILTER (model = 'challenger') AS a, max(f1) FILTER (model = 'champion') AS b FROM f1)
    SELECT round(a, 6)::DOUBLE AS f1_challenger, round(b, 6)::DOUBLE AS f1_champion,
           round(coalesce(a - b, 0), 6)::DOUBLE AS changed_accuracy,
           {accepted} AS model_accepted, {accepted} AS active FROM pair"""


_RANKED = """ranks AS (
    SELECT o_orderstatus, (row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1)::DOUBLE AS label
    FROM orders GROUP BY 1)"""
_CASE_SPLIT = f"CASE WHEN {digest('case_id', 100)} < 70 THEN 'train' ELSE 'test' END"

ORACLES = {
    "confusion_counts": f"""SELECT o_orderstatus AS label, {_BY_PRICE} AS prediction, count(*) AS cnt
        FROM orders GROUP BY 1, 2""",
    "metric_set": _metric_sql(_QUALITY, "0"),
    "metric_set_three_classes": _metric_sql(
        f"SELECT o_orderstatus AS label, {_BY_PRICE} AS prediction FROM orders", "'F'"
    ),
    "metric_set_by_split": _metric_sql(
        f"""SELECT {_SPLIT} AS split, o_orderstatus AS label,
            CASE WHEN o_totalprice < 250000 THEN 'F' ELSE 'O' END AS prediction FROM orders""",
        "'O'",
        "split, ",
    ),
    "class_metrics": f"""WITH {_rates(f"SELECT o_orderstatus AS label, {_BY_PRIORITY} AS prediction FROM orders")}
        SELECT class, n::BIGINT AS n, p::BIGINT AS p, tp::BIGINT AS tp, total::BIGINT AS total,
               round(prec, 6) AS precision, round(rec, 6) AS recall, round(fpr, 6) AS false_positive_rate,
               round(f, 6) AS f_measure FROM rates""",
    "challenger_gate": _gate_sql(_BOTH, "a - b >= 0.002"),
    "challenger_gate_with_floor": _gate_sql(_BOTH, "(a - b >= -1.0 AND a >= 0.6)"),
    "first_model_gate": _gate_sql(_FIRST, "b IS NULL"),
    "label_index": f"WITH {_RANKED} SELECT o_orderkey, label FROM orders JOIN ranks USING (o_orderstatus)",
    "label_decode": "SELECT o_orderkey, o_orderstatus AS status FROM orders",
    "validated_cases": f"""WITH {CASES} SELECT case_id, priority, outcome, {_CASE_SPLIT} AS split
        FROM cases WHERE outcome <> 'N/A'""",
    "held_out_cases": f"""WITH {CASES} SELECT case_id, outcome FROM cases
        WHERE outcome <> 'N/A' AND {_CASE_SPLIT} = 'test'""",
    "feature_vectors": f"""WITH d AS (
            SELECT doc_id, lang, source, n_chars::DOUBLE AS n,
                   CASE WHEN {digest('doc_id', 100)} < 70 THEN 'train' ELSE 'test' END AS split
            FROM documents JOIN labels USING (doc_id)),
        t AS (SELECT *, count(*) OVER (PARTITION BY source) AS fe, count(*) OVER (PARTITION BY lang) AS nl,
                     count(*) OVER () AS total FROM d WHERE split = 'train'),
        langs AS (SELECT lang, sqrt(any_value(nl) * (1 - any_value(nl)::DOUBLE / any_value(total))
                  / (any_value(total) - 1)) AS dev FROM t GROUP BY 1),
        sources AS (SELECT source, any_value(fe)::DOUBLE AS fe FROM t GROUP BY 1),
        devs AS (SELECT stddev_samp(fe) AS source_dev, stddev_samp(n) AS n_dev FROM t)
        SELECT doc_id, split, round(coalesce(1 / dev, 0), 6) AS lang, round(coalesce(fe, 0) / source_dev, 6) AS source,
               round(n / n_dev, 6) AS length, {DOCUMENT_SPEC.text_slots} AS word_slots
        FROM d LEFT JOIN langs USING (lang) LEFT JOIN sources USING (source), devs""",
    "retrain_gate": f"""WITH {CASES}, judged AS (SELECT count(*) AS judged FROM cases
            WHERE outcome <> 'N/A' AND {_CASE_SPLIT} = 'test')
        SELECT 'first' AS run_id, true AS model_accepted, true AS active, 1::BIGINT AS version, judged FROM judged
        UNION ALL SELECT 'second', false, false, NULL, judged FROM judged""",
    "score_coverage": "SELECT o_orderkey AS case_id, 1::BIGINT AS times, true AS known FROM orders",
    "metrics_crosscheck": f"""WITH {CASES}, judged AS (SELECT count(*) AS rows FROM cases
            WHERE outcome <> 'N/A' AND {_CASE_SPLIT} = 'test')
        SELECT unnest({list(METRIC_NAMES)!r}) AS metric, true AS equal, rows FROM judged""",
    "saved_equals_fitted": "SELECT o_orderkey AS case_id, true AS equal FROM orders",
    "stream_equals_batch": "SELECT o_orderkey AS case_id, true AS equal FROM orders",
    "batch_score_inputs": f"""WITH {CASES} SELECT CASE outcome WHEN 'Yes' THEN 'good' WHEN 'No' THEN 'mixed'
            ELSE 'Missing columns: [''segment'']' END AS place, count(*) AS n_rows FROM cases GROUP BY 1 UNION ALL SELECT 'broken', 1""",
    "stream_score_wide_frequency": "SELECT doc_id, true AS equal FROM documents",
    "scores_in_one_store": "SELECT o_orderkey AS case_id, 1::BIGINT AS times FROM orders",
    "resumed_run": "SELECT o_orderkey AS case_id, true AS equal FROM orders",
    "batch_score_types": f"""WITH {CASES} SELECT case_id, CASE outcome WHEN 'Yes' THEN 'plain' WHEN 'No' THEN 'texts'
            ELSE 'Unfit types: [''channel array<string>'']' END AS place, CASE WHEN outcome <> 'N/A' THEN true END AS equal FROM cases""",
    "batch_score_absent_input": f"""WITH {CASES} SELECT 'here' AS input, true AS valid, 0 AS n_missing, count(*) AS n_rows FROM cases
        UNION ALL SELECT 'gone', false, {len(CASE_SPEC.scoring_columns)}, 0""",
    "unlabelled_documents_scored": "SELECT doc_id, true AS known FROM documents ANTI JOIN labels USING (doc_id)",
    "batch_score_archive": """SELECT 'archive' AS place, o_orderkey AS id FROM orders
        UNION ALL SELECT 'failed', c_custkey FROM customer""",
}
