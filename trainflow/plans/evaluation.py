"""Deciding on a trained model and keeping the record of it."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainflow.operators import history
from trainflow.operators.gate import CHALLENGER, CHAMPION, decide, two_model_counts
from trainflow.operators.metrics import confusion_counts
from trainflow.operators.quality import quoted
from trainflow.sources.files import NumberedLog
from trainflow.sources.tables import append, read_if_present
from trainflow.spec import FeatureSpec

RECORD_KEY = ["run_id"]
RECORD_VERSION = "created_timestamp"
RECORD_DELETED = "deleted"
RECORD_CHANGE = "change"


@dataclass(frozen=True)
class Verdict:
    accepted: bool
    changed_accuracy: float
    f1_challenger: float
    f1_champion: float | None


def evaluate(
    held_out: DataFrame,
    spec: FeatureSpec,
    challenger: PipelineModel,
    champion: PipelineModel | None,
    min_gain: float,
    min_f1: float | None = None,
    challenger_counts: DataFrame | None = None,
) -> Verdict:
    """Both models on the same held-out rows, by class name.

    With the confusion counts of the challenger, ``label, prediction, cnt``, only the champion scores
    the rows; else both do, in one pass.
    """
    rows = held_out.withColumn(spec.target, quoted(spec.target).cast("string"))

    def scored(df: DataFrame, model: PipelineModel, name: str) -> DataFrame:
        return model.transform(df).select(*map(quoted, df.columns), quoted(spec.predicted_target).alias(name))

    def counted(model: PipelineModel, name: str) -> DataFrame:
        return confusion_counts(scored(rows, model, "__prediction"), spec.target, "__prediction").withColumn("model", F.lit(name))

    if champion is not None and challenger_counts is None:
        both = scored(scored(rows, challenger, "__challenger"), champion, "__champion")
        counts = two_model_counts(both, spec.target, "__challenger", "__champion")
    else:
        own = challenger_counts
        counts = counted(challenger, CHALLENGER) if own is None else own.withColumn("model", F.lit(CHALLENGER))
        if champion is not None:
            counts = counts.unionByName(counted(champion, CHAMPION))
    row = decide(counts, min_gain, min_f1).first()
    if row is None:
        raise ValueError("no held-out rows with a known target to evaluate on")
    return Verdict(row["model_accepted"], row["changed_accuracy"], row["f1_challenger"], row["f1_champion"])


class EvaluationLog:
    """Evaluation records: insert, find, update and delete on an append-only table.

    Nothing is rewritten; the newest version of a record counts, and a delete is a version too. An update
    or delete counts once it is entered in the log of changes. Of two that were worked out from the
    same state at a time one is refused, with :class:`Conflict`, and leaves nothing behind.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.changes = NumberedLog(spark, f"{self.path}/_changes")

    def insert(
        self,
        run_id: str,
        verdict: Verdict,
        trained_model_path: str,
        best_model_path: str | None = None,
        active: bool | None = None,
    ) -> None:
        row = (
            self.spark.range(1).select(
                F.lit(run_id).alias("run_id"),
                F.lit(verdict.accepted).alias("model_accepted"),
                F.lit(verdict.changed_accuracy).cast("double").alias("changed_accuracy"),
                F.lit(trained_model_path).alias("trained_model_path"),
                F.lit(best_model_path).cast("string").alias("best_model_path"),
                F.lit(verdict.accepted if active is None else active).alias("active"),
            )
        )
        append(self._stamped(row, False), self.path)

    def _stamped(self, records: DataFrame, deleted: bool) -> DataFrame:
        return records.withColumns({RECORD_VERSION: F.current_timestamp(), RECORD_DELETED: F.lit(deleted)})

    def _change(self, records: DataFrame, deleted: bool, seen: int) -> None:
        """Writes new versions of records that were read after the change ``seen``, and enters them."""
        rows = uuid.uuid4().hex
        self._stamped(records, deleted).write.parquet(f"{self.path}/_rows/{rows}")
        self.changes.append({"rows": rows}, after=seen)

    def log(self) -> DataFrame | None:
        """All versions of all records, each with the number of the change that made it, or 0."""
        log = read_if_present(self.spark, self.path)
        if log is None:
            return None
        log = log.withColumn(RECORD_CHANGE, F.lit(0).cast("long"))
        for entry in self.changes.entries():
            rows = self.spark.read.schema(log.drop(RECORD_CHANGE).schema).parquet(f"{self.path}/_rows/{entry['rows']}")
            log = log.unionByName(rows.withColumn(RECORD_CHANGE, F.lit(entry["number"]).cast("long")))
        return log

    def records(self, query=None) -> DataFrame:
        """Current records, all or those that meet a condition."""
        log = self.log()
        if log is None:
            raise LookupError(f"no evaluation records at {self.path}")
        order = [RECORD_VERSION, RECORD_CHANGE]
        return history.find(log, RECORD_KEY, order, RECORD_DELETED, F.lit(True) if query is None else query).drop(RECORD_CHANGE)

    def first(self, query=None):
        """One matching record, the oldest, or None."""
        return self.records(query).orderBy(RECORD_VERSION, "run_id").first()

    def update(self, query, **changes) -> None:
        """Append a new version of each matching record with the changed fields."""
        seen = self.changes.last()
        records = self.records(query).drop(RECORD_VERSION)
        kinds = {f.name: f.dataType for f in records.schema.fields}
        self._change(records.withColumns({c: F.lit(v).cast(kinds[c]) for c, v in changes.items()}), False, seen)

    def delete(self, query) -> None:
        """Append a delete mark for every matching record."""
        seen = self.changes.last()
        self._change(self.records(query).drop(RECORD_VERSION), True, seen)

    def delete_one(self, query) -> None:
        """Append a delete mark for the oldest matching record."""
        row = self.first(query)
        if row is not None:
            self.delete(F.col("run_id") == row["run_id"])
