"""The training workflow, stage by stage, with a table between stages.

ingest -> validate -> prepare -> train -> evaluate -> register if accepted
"""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainflow.operators.lookup import hashable
from trainflow.operators.quality import (
    ACCEPTED_COLUMN,
    ERROR_COLUMN,
    check_required,
    known_target,
    split_columns,
    unwanted_columns,
    with_verdict,
)
from trainflow.operators.splits import TEST, TRAIN, with_split
from trainflow.plans.evaluation import EvaluationLog, Verdict, evaluate
from trainflow.plans.features import FeatureProfile, fit_and_store, fit_stored, profile_features, store_inputs
from trainflow.plans.training import fit_classifier, fit_labels, scoring_model, split_counts, split_metrics
from trainflow.sources.files import NumberedLog, delete, exists
from trainflow.sources.landing import compact, compact_enveloped, read_store, refuse_names
from trainflow.sources.registry import ModelRegistry
from trainflow.sources.tables import create, read_table, replace
from trainflow.sources.watermark import LoadSpan, record_load
from trainflow.spec import MIN_F1_GAIN, UNKNOWN_TARGET_REASON, FeatureSpec, RunPaths
from trainflow.workspace import released

SPLIT = "split"


@dataclass(frozen=True)
class TrainingReport:
    """What a run did."""

    run_id: str
    dropped_columns: list[str]
    metrics: dict[str, dict[str, float]]
    verdict: Verdict
    registered_path: str | None


def ingest(
    spark: SparkSession, record: T.StructType, span: LoadSpan, paths: RunPaths, enveloped: bool = False
) -> DataFrame | None:
    """Add the run's landing files to the feature store and move the watermark; None if nothing is due.

    ``enveloped`` files hold ``{"_source": {..}}`` elements. A load that broke off before its watermark
    was written is repeated by the next run, and replaces what it left: it is named by its start alone,
    as the next run may reach further. Without landing files only the watermark moves.
    """
    if span.empty:
        return None
    add = compact_enveloped if enveloped else compact
    add(spark, paths.landing, record, paths.feature_store, load=f"from-{span.start}")
    record_load(spark, paths.watermarks, span, paths.feature_store)
    return read_store(spark, paths.feature_store, record)


def validate(df: DataFrame, spec: FeatureSpec, paths: RunPaths, again: bool = False) -> tuple[DataFrame, list[str]]:
    """Drop poor columns, reject rows without target, mark the split: one pass for the counts, one to
    write all rows, and one over the rejected columns alone.

    Tables that are there already are an error, unless they are to be written ``again``.
    """
    write = replace if again else create
    refuse_names(df.columns, (SPLIT, ACCEPTED_COLUMN, ERROR_COLUMN))
    unwanted = unwanted_columns(df, spec.max_missing_percent, spec.always_drop, keep=spec.key)
    kept, rejected = split_columns(df, unwanted, spec.key)
    check_required(kept, spec.required_columns)
    judged = with_verdict(kept, known_target(spec.target, spec.unknown_target), UNKNOWN_TARGET_REASON)
    if again:
        # Partitions of the attempt that broke off go too.
        delete(df.sparkSession, paths.validated)
    write(with_split(judged, spec.key, spec.test_percent, SPLIT), paths.validated, [ACCEPTED_COLUMN, SPLIT])
    if unwanted:
        write(rejected, paths.rejected_columns)
    return accepted(df.sparkSession, paths), unwanted


def accepted(spark: SparkSession, paths: RunPaths) -> DataFrame:
    """Accepted rows of a validated run; reads only their partitions."""
    rows = read_table(spark, paths.validated).where(F.col(ACCEPTED_COLUMN).cast("boolean"))
    return rows.drop(ACCEPTED_COLUMN, ERROR_COLUMN)


def rejected(spark: SparkSession, paths: RunPaths) -> DataFrame:
    """Rejected rows with their reason."""
    rows = read_table(spark, paths.validated).where(~F.col(ACCEPTED_COLUMN).cast("boolean"))
    return rows.drop(ACCEPTED_COLUMN, SPLIT)


def prepare(df: DataFrame, spec: FeatureSpec, paths: RunPaths) -> tuple[PipelineModel, DataFrame]:
    """Fit features on the train part, store the vector inputs of both parts in one pass."""
    return fit_and_store(df, spec, SPLIT, TRAIN, paths.transformed)


def train(
    vectors: DataFrame, spec: FeatureSpec, features: PipelineModel, paths: RunPaths
) -> tuple[PipelineModel, dict[str, dict[str, float]], DataFrame]:
    """Fit labels and classifier on the train part, measure both parts, save the joined model.

    The saved model holds all feature stages too, so it is the only copy a run writes. Metrics are by
    class name, so a class only the test part has counts too. Also returns the confusion counts.
    """
    train_part = vectors.where(F.col(SPLIT) == TRAIN)
    labels = fit_labels(train_part, spec)
    labels.write().overwrite().save(paths.label_indexer)
    classifier = fit_classifier(labels.transform(train_part), spec, labels)
    counts = split_counts(classifier.transform(vectors), spec, SPLIT)
    metrics = split_metrics(counts, labels.labels[0], SPLIT)
    model = scoring_model(features, classifier)
    model.write().overwrite().save(paths.trained_model)
    return model, metrics, counts


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's columns and rows, in any order: one aggregation over it."""
    row = F.xxhash64(*(F.coalesce(F.hash(c), F.lit(0)) for c in hashable(df)), *hashable(df))
    found = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).first()
    return hashlib.sha256(repr((df.schema.simpleString(), *found)).encode()).hexdigest()


class TrainingRun:
    """A training run, stage by stage. What a stage has found is entered in the run's log of stages when its
    tables are complete, so a run that broke off is started again with the same id and does only the rest.

    The log begins with a digest of the input and the settings; a run id belongs to one of them.
    ``input_digest`` may name the input's version, if the caller knows it, to save a pass over the rows.
    """

    def __init__(
        self,
        df: DataFrame,
        spec: FeatureSpec,
        paths: RunPaths,
        model_key: str = "classifier",
        min_gain: float = MIN_F1_GAIN,
        min_f1: float | None = None,
        version: int | None = None,
        input_digest: str | None = None,
    ):
        self.spark, self.df, self.spec, self.paths = df.sparkSession, df, spec, paths
        self.model_key, self.min_gain, self.min_f1, self.version = model_key, min_gain, min_f1, version
        self.registry = ModelRegistry(self.spark, paths.registry, paths.saved_models)
        self.log = NumberedLog(self.spark, paths.stages)
        settings = repr((spec, model_key, min_gain, min_f1, version))
        begun = {"stage": "begin", "digest": input_digest or fingerprint(df), "settings": settings}
        entries = self.log.entries()
        self.resumed = bool(entries)
        if not entries:
            # A folder of a run without a log is somebody else's.
            if exists(self.spark, paths.validated):
                raise FileExistsError(f"PATH_ALREADY_EXISTS: {paths.validated}")
            self.log.append(begun, after=0)
        elif {k: v for k, v in entries[0].items() if k != "number"} != begun:
            raise ValueError(f"run {paths.run_id} was begun with another input, spec or setting")
        self.done = {e["stage"]: e for e in entries}
        self.last = entries[-1]["number"] if entries else 1

    def _enter(self, stage: str, **found) -> dict:
        self.last = self.log.append({"stage": stage, **found}, after=self.last)
        self.done[stage] = found
        return found

    def validate(self) -> DataFrame:
        """The accepted rows."""
        if "validate" not in self.done:
            rows, dropped = validate(self.df, self.spec, self.paths, again=self.resumed)
            self._enter("validate", dropped=dropped)
            return rows
        return accepted(self.spark, self.paths)

    def _profile(self) -> FeatureProfile:
        found = self.done["prepare"]
        counts = read_table(self.spark, self.paths.category_counts)
        return FeatureProfile(counts, found["labels"], found["means"])

    def prepare(self) -> tuple[PipelineModel, DataFrame]:
        """The fitted features and the vectors of all rows."""
        if "prepare" not in self.done:
            rows = self.validate()
            profile = profile_features(rows.where(F.col(SPLIT) == TRAIN), self.spec)
            replace(profile.counts, self.paths.category_counts)
            store_inputs(rows, self.spec, profile, SPLIT, self.paths.transformed)
            self._enter("prepare", labels=profile.labels, means=profile.means)
        return fit_stored(self.spark, self.spec, self._profile(), SPLIT, TRAIN, self.paths.transformed)

    def train(self) -> tuple[PipelineModel, DataFrame]:
        """The model and its confusion counts."""
        if "train" not in self.done:
            features, vectors = self.prepare()
            model, metrics, counts = train(vectors, self.spec, features, self.paths)
            replace(counts, self.paths.confusion)
            self._enter("train", metrics=metrics)
            return model, read_table(self.spark, self.paths.confusion)
        return PipelineModel.load(self.paths.trained_model), read_table(self.spark, self.paths.confusion)

    def evaluate(self) -> Verdict:
        """The verdict on the model beside the newest one."""
        if "evaluate" not in self.done:
            model, counts = self.train()
            best_path = self.registry.newest_path(self.model_key)
            champion = self.registry.load_newest(self.model_key) if best_path else None
            held_out = self.validate().where(F.col(SPLIT) == TEST)
            own = counts.where(F.col(SPLIT) == TEST).drop(SPLIT)
            verdict = evaluate(held_out, self.spec, model, champion, self.min_gain, self.min_f1, own)
            EvaluationLog(self.spark, self.paths.evaluations).insert(self.paths.run_id, verdict, self.paths.trained_model, best_path)
            self._enter("evaluate", verdict=asdict(verdict))
        return Verdict(**self.done["evaluate"]["verdict"])

    def register(self) -> None:
        """Lists an accepted model, once."""
        verdict = self.evaluate()
        if "register" not in self.done:
            listed = self.registry.versions(self.model_key).where(F.col("path") == self.paths.trained_model)
            if verdict.accepted and listed.isEmpty():
                self.registry.list_saved(self.paths.trained_model, self.model_key, verdict.f1_challenger, self.version)
            self._enter("register")

    def report(self) -> TrainingReport:
        """All stages that are not done yet, and what the run did."""
        with released(self.spark):
            self.register()
        verdict = self.evaluate()
        path = self.paths.trained_model if verdict.accepted else None
        return TrainingReport(self.paths.run_id, self.done["validate"]["dropped"], self.done["train"]["metrics"], verdict, path)


def run_training(
    df: DataFrame,
    spec: FeatureSpec,
    paths: RunPaths,
    model_key: str = "classifier",
    min_gain: float = MIN_F1_GAIN,
    min_f1: float | None = None,
    version: int | None = None,
    input_digest: str | None = None,
) -> TrainingReport:
    """All stages on one table. An accepted model becomes the newest version of ``model_key``.

    What the run needs later is in its folders; its other tables are deleted when it ends. A run that broke
    off goes on where it was, if it is started again with the same id, input and settings.
    """
    return TrainingRun(df, spec, paths, model_key, min_gain, min_f1, version, input_digest).report()
