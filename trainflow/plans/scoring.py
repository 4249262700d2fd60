"""Scoring tables and files with the newest accepted model."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainflow.operators.quality import ERROR_COLUMN, quoted
from trainflow.sources.files import NumberedLog, exists, literal, matches, move
from trainflow.sources.inventory import FOOTERS, check_files, missing_by_input
from trainflow.sources.ledger import Load, Loads
from trainflow.sources.registry import ModelRegistry
from trainflow.sources.tables import replace
from trainflow.spec import FeatureSpec, RunPaths
from trainflow.workspace import released, written

SOURCE_FILE = "source_file"


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every row with all model outputs; no cap on rows."""
    return model.transform(df)


def predictions(model: PipelineModel, df: DataFrame, spec: FeatureSpec, extra: Sequence[str] = ()) -> DataFrame:
    """The scoring columns and the predicted class."""
    columns = [*extra, *spec.scoring_columns, spec.predicted_target]
    return score(model, df).select(*map(quoted, columns))


def score_into(
    model: PipelineModel, df: DataFrame, spec: FeatureSpec, output: str, name: str | None = None, extra: Sequence[str] = (), **source
) -> Load:
    """Adds predictions to a store of them, as one load. A load with a name replaces what an earlier attempt
    of it left. Batch jobs and batches of streams may add to one store."""
    with released(df.sparkSession):
        return Loads(df.sparkSession, output).write(predictions(model, df, spec, extra), None, name, **source)


def read_scores(spark: SparkSession, output: str) -> DataFrame:
    """The predictions of all loads of a store."""
    rows = Loads(spark, output).read()
    if rows is None:
        raise LookupError(f"nothing was scored into {output}")
    return rows


@dataclass(frozen=True)
class ScoringReport:
    valid: list[str]
    invalid: dict[str, list[str]]
    predictions: str | None


def _role_type(spec: FeatureSpec, column: str) -> T.DataType:
    return next((f.dataType for f in spec.schema().fields if f.name == column), T.StringType())


def unfit_types(spec: FeatureSpec, schema: T.StructType) -> list[str]:
    """Scoring columns and keys whose type can't be read as what their role needs, as ``name type``."""
    found = []
    for f in schema.fields:
        if f.name not in (*spec.key, *spec.scoring_columns):
            continue
        wanted, simple = _role_type(spec, f.name), isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType, T.DatetimeType))
        if isinstance(wanted, T.TimestampType):
            simple = isinstance(f.dataType, (T.StringType, T.DatetimeType))
        elif isinstance(wanted, T.DoubleType):
            simple = isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType))
        if not simple:
            found.append(f"{f.name} {f.dataType.simpleString()}")
    return found


def _together(spark: SparkSession, spec: FeatureSpec, kinds: list[tuple[T.StructType, list[str]]]) -> DataFrame:
    """Keys, scoring columns and source file of files of several schemas, as one table.

    A column that has one type in all files keeps it. Otherwise, or if a number comes as text, it is read
    as its role declares; a value that can't be read so is null. Columns that are not needed are not read.
    """
    wanted = [*spec.key, *spec.scoring_columns]
    types = {c: {s[c].dataType.simpleString(): s[c].dataType for s, _ in kinds if c in s.names} for c in dict.fromkeys(wanted)}
    parts = []
    for schema, paths in kinds:
        rows = spark.read.schema(schema).parquet(*map(literal, paths))
        columns = [F.col("_metadata.file_path").alias(SOURCE_FILE)]
        for c, found in types.items():
            if not found:
                continue
            role, own = _role_type(spec, c), next(iter(found.values()))
            text_number = isinstance(role, T.DoubleType) and not isinstance(own, T.NumericType)
            kind = own if len(found) == 1 and not text_number else role
            value = quoted(c) if c in schema.names else F.lit(None)
            same = c in schema.names and schema[c].dataType == kind
            columns.append((value if same else value.try_cast(kind)).alias(c))
        parts.append(rows.select(*columns))
    return reduce(DataFrame.unionByName, parts)


class Archive:
    """Moves of scored files into a run's archive, each noted before it is made, so that they can be ended
    by whoever comes next."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.log = NumberedLog(spark, f"{self.folder}/_moves")

    def plan(self, owned: dict[str, list[str]], about: dict) -> dict:
        """Notes which files of each input will be moved, and what else has to be known to end the run."""
        number, moves = self.log.last() + 1, []
        for i, (given, paths) in enumerate(owned.items()):
            roots = matches(self.spark, given)
            for path in paths:
                root = max((r for r in roots if path.startswith(r)), key=len)
                rest = path[len(root) :].strip("/") or path.rpartition("/")[2]
                moves.append([path, f"{self.folder}/batch={number}/input={i}/{rest}"])
        entry = about | {"moves": moves}
        return entry | {"number": self.log.append(entry, after=number - 1)}

    def open(self) -> dict | None:
        """The moves that were noted and not ended."""
        entries = self.log.entries()
        return entries[-1] if entries and "moves" in entries[-1] else None

    def end(self, entry: dict) -> None:
        """Makes the moves that are still to be made. A file that is gone was moved before."""

        def one(pair: list[str]) -> None:
            if exists(self.spark, pair[0]):
                move(self.spark, *pair)

        with ThreadPoolExecutor(FOOTERS) as pool:
            list(pool.map(one, entry["moves"]))
        self.log.append({"ended": entry["number"]})


def score_files(
    spark: SparkSession,
    spec: FeatureSpec,
    registry: ModelRegistry,
    model_key: str,
    inputs: Sequence[str],
    paths: RunPaths,
) -> ScoringReport:
    """Score all files that have the needed columns as one table, archive them, set the others aside.

    Files are judged one by one, also within a folder, whatever schemas the others have. Rows of files
    that lack columns, or hold them in types that do not fit, go below the folder of failed ones, in one
    write for each schema; ``unreadable`` there lists files that are no tables and inputs that are absent.
    ``valid`` are inputs with a file that was scored, ``invalid`` those with one that was not.

    The scored files themselves are moved into the archive once the predictions are written; no row is
    read for it. A run that broke off between the moves makes the rest of them when it is started again,
    and scores nothing twice. Files that were not scored stay where they are.
    """
    archive = Archive(spark, paths.archive)
    if (left := archive.open()) is not None:
        archive.end(left)
        if left["inputs"] == list(inputs):
            return ScoringReport(left["valid"], left["invalid"], paths.predictions)
    files = written(check_files(spark, inputs, spec.scoring_columns, lambda s: unfit_types(spec, s)), "files")
    kinds = files.where(F.col("reason").isNotNull() & F.col("schema").isNotNull()).groupBy("schema", "reason")
    failing = kinds.agg(F.collect_list("path").alias("paths")).orderBy("schema")
    for number, kind in enumerate(failing.collect()):
        schema = T.StructType.fromJson(json.loads(kind["schema"]))
        rows = spark.read.schema(schema).parquet(*map(literal, kind["paths"]))
        replace(rows.withColumn(ERROR_COLUMN, F.lit(kind["reason"])), f"{paths.failed}/{number}")
    broken = files.where("schema IS NULL").select("path", F.col("reason").alias(ERROR_COLUMN))
    if not broken.isEmpty():
        replace(broken, f"{paths.failed}/unreadable")
    absent = missing_by_input(files)
    good = files.where("reason IS NULL").select("input", "path", "schema").orderBy("path").collect()
    owned: dict[str, list[str]] = {}
    for r in good:
        owned.setdefault(r["input"], []).append(r["path"])
    report = ([p for p in inputs if p in owned], {p: absent[p] for p in inputs if absent.get(p)})
    if not good:
        return ScoringReport(*report, None)
    by_schema: dict[str, list[str]] = {}
    for r in good:
        by_schema.setdefault(r["schema"], []).append(r["path"])
    rows = _together(spark, spec, [(T.StructType.fromJson(json.loads(s)), found) for s, found in by_schema.items()])
    keys = [c for c in spec.key if c in rows.columns]
    scored = predictions(registry.load_newest(model_key), rows, spec, [*keys, SOURCE_FILE])
    replace(scored, paths.predictions)
    archive.end(archive.plan(owned, {"inputs": list(inputs), "valid": report[0], "invalid": report[1]}))
    return ScoringReport(*report, paths.predictions)
