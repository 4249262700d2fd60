"""The feature pipeline, built from a spec."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainflow.functions import elapsed_days
from trainflow.operators.frequency import cardinality, value_counts
from trainflow.operators.quality import quoted
from trainflow.operators.stages import ConstantFiller, ElapsedDays, FrequencyEncoder, ModeImputer, ModeImputerModel
from trainflow.sources.tables import read_table, replace
from trainflow.spec import WORD_COUNTS, FeatureSpec
from trainflow.workspace import written


@dataclass(frozen=True)
class FeatureProfile:
    """What the column stages learn from the training rows, in two passes."""

    counts: DataFrame
    labels: dict[str, list[str]]
    means: dict[str, float | None]

    @property
    def empty_numbers(self) -> list[str]:
        return [c for c, mean in self.means.items() if mean is None]


def profile_features(train: DataFrame, spec: FeatureSpec) -> FeatureProfile:
    """Value counts of all categories in one pass, means of all numbers in another.

    A categorical column without values, or with more than ``spec.max_categories``, is an error: an
    index keeps its labels on the driver. Columns with more values belong into ``spec.frequency``.
    """
    counts = written(value_counts(train, [*spec.categorical, *spec.frequency]), "category_counts")
    own = counts.where(F.col("value").isNotNull() & F.col("column").isin(list(spec.categorical)))
    sizes = {r["column"]: r["n_category"] for r in cardinality(own).collect()}
    if empty := [c for c in spec.categorical if c not in sizes]:
        raise ValueError(f"categorical columns without any value: {empty}")
    if wide := {c: n for c, n in sizes.items() if n > spec.max_categories}:
        raise ValueError(f"more than {spec.max_categories} categories, use frequency columns: {wide}")
    labels: dict[str, list[str]] = {c: [] for c in spec.categorical}
    # Bounded by the check above.
    for row in own.orderBy("column", F.desc("cnt"), "value").collect():
        labels[row["column"]].append(row["value"])
    numbers = {c: quoted(c) for c in spec.numeric}
    numbers.update({out: elapsed_days(quoted(a), quoted(b)) for a, b, out in spec.date_pairs})
    means = [F.avg(F.nanvl(v.cast("double"), F.lit(None))) for v in numbers.values()]
    row = train.agg(*means).first() if means else []
    return FeatureProfile(counts, labels, dict(zip(numbers, row, strict=True)))


def learnt_stages(spec: FeatureSpec, profile: FeatureProfile) -> list:
    """The stages of :func:`column_stages`, fitted from the profile: no further pass over the rows."""
    spark = profile.counts.sparkSession
    fitted = []
    for stage in column_stages(spec, profile.empty_numbers):
        if isinstance(stage, Imputer):
            means = [tuple(profile.means[c] for c in stage.getInputCols())]
            stage = stage.fit(spark.createDataFrame(means, ", ".join(f"`{c}` double" for c in stage.getInputCols())))
        elif isinstance(stage, ModeImputer):
            model = ModeImputerModel(inputCols=stage.getInputCols(), outputCols=stage.getOutputCols())
            stage = model.setModes([profile.labels[c][0] for c in spec.categorical])
        elif isinstance(stage, StringIndexer):
            # One model a column: an index of several columns cannot be made from lists of unequal length.
            columns = zip(spec.categorical, stage.getInputCols(), stage.getOutputCols(), strict=True)
            indexed = [StringIndexerModel.from_labels(profile.labels[c], i, o, "keep") for c, i, o in columns]
            fitted += indexed
            continue
        elif isinstance(stage, OneHotEncoder):
            imputed = spark.createDataFrame([], ", ".join(f"`{i.getInputCol()}` string" for i in indexed))
            stage = stage.fit(PipelineModel(stages=indexed).transform(imputed))
        elif isinstance(stage, FrequencyEncoder):
            stage = stage.fit_counts(profile.counts)
        fitted.append(stage)
    return fitted


def column_stages(spec: FeatureSpec, empty_numbers: Sequence[str] = ()) -> list:
    """Stages from raw columns to numbers, one-hot vectors and word counts. None of them is fitted on
    the text."""
    stages = []
    if spec.date_pairs:
        pairs = [c for a, b, _ in spec.date_pairs for c in (a, b)]
        stages.append(ElapsedDays(inputCols=pairs, outputCols=[out for _, _, out in spec.date_pairs]))
    filled = [c for c in spec.numbers if c not in set(empty_numbers)]
    if filled:
        stages.append(Imputer(strategy="mean", inputCols=filled, outputCols=[f"im_{c}" for c in filled]))
    if empty_numbers:
        stages.append(
            ConstantFiller(
                inputCols=list(empty_numbers),
                outputCols=[f"im_{c}" for c in empty_numbers],
                values=[spec.numeric_fallback] * len(empty_numbers),
            )
        )
    if spec.categorical:
        raw = list(spec.categorical)
        imputed, indexed, encoded = ([f"{p}_{c}" for c in raw] for p in ("im", "si", "tf"))
        stages += [
            ModeImputer(inputCols=raw, outputCols=imputed),
            StringIndexer(inputCols=imputed, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
    if spec.frequency:
        raw = list(spec.frequency)
        stages.append(FrequencyEncoder(inputCols=raw, outputCols=[f"fe_{c}" for c in raw]))
    if spec.text:
        stages += [
            ConstantFiller(inputCols=[spec.text], outputCols=["filled_text"], values=[""]),
            Tokenizer(inputCol="filled_text", outputCol="words"),
            HashingTF(inputCol="words", outputCol=WORD_COUNTS, numFeatures=spec.text_slots),
        ]
    return stages


def vector_stages(spec: FeatureSpec) -> list:
    """Stages from the outputs of :func:`column_stages` to one scaled vector."""
    stages = []
    if spec.text:
        stages.append(IDF(inputCol=WORD_COUNTS, outputCol=f"tf_{spec.text}", minDocFreq=spec.min_doc_freq))
    return [
        *stages,
        VectorAssembler(inputCols=spec.vector_inputs, outputCol=spec.vector, handleInvalid="error"),
        StandardScaler(inputCol=spec.vector, outputCol=spec.features, withStd=True, withMean=False),
    ]


def feature_pipeline(spec: FeatureSpec, empty_numbers: Sequence[str] = ()) -> Pipeline:
    """Stages from raw columns to one scaled vector.

    Every stage is free of nulls and safe for values unseen in training: an unseen or null category
    becomes a zero vector, an unseen frequency 0.
    """
    return Pipeline(stages=[*column_stages(spec, empty_numbers), *vector_stages(spec)])


def fit_features(train: DataFrame, spec: FeatureSpec) -> PipelineModel:
    """Fit on the training rows."""
    first = PipelineModel(stages=learnt_stages(spec, profile_features(train, spec)))
    second = Pipeline(stages=vector_stages(spec)).fit(first.transform(train))
    return PipelineModel(stages=[*first.stages, *second.stages])


def fit_and_store(
    rows: DataFrame, spec: FeatureSpec, split: str, train: str, path: str
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the ``train`` rows of a stored table and prepare all rows, reading the text only once.

    A plain fit splits every text for the IDF, for the scaler and again for the result. Here the
    word counts are stored with the other inputs of the vector, and the last stages use those.
    Returns the whole model, and ``key, features, target, split`` of all rows.
    """
    profile = profile_features(rows.where(F.col(split) == train), spec)
    store_inputs(rows, spec, profile, split, path)
    return fit_stored(rows.sparkSession, spec, profile, split, train, path)


def _stored_inputs(spec: FeatureSpec) -> list[str]:
    return [WORD_COUNTS if c == f"tf_{spec.text}" else c for c in spec.vector_inputs]


def store_inputs(rows: DataFrame, spec: FeatureSpec, profile: FeatureProfile, split: str, path: str) -> None:
    """Stores the inputs of the vector of all rows."""
    first = PipelineModel(stages=learnt_stages(spec, profile))
    prepared = first.transform(rows).select(*map(quoted, [*spec.key, *_stored_inputs(spec), spec.target, split]))
    replace(prepared, path, [split])


def fit_stored(
    spark: SparkSession, spec: FeatureSpec, profile: FeatureProfile, split: str, train: str, path: str
) -> tuple[PipelineModel, DataFrame]:
    """The whole model, from the profile and the stored inputs of the vector; raw rows are not read again."""
    first = PipelineModel(stages=learnt_stages(spec, profile))
    stored = read_table(spark, path)
    second = Pipeline(stages=vector_stages(spec)).fit(stored.where(F.col(split) == train))
    vectors = second.transform(stored).select(*map(quoted, [*spec.key, spec.features, spec.target, split]))
    return PipelineModel(stages=[*first.stages, *second.stages]), vectors


def stage_report(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``position, stage, param, value`` of every parameter of a fitted pipeline.

    Output names that Spark makes up from a stage's random id, and folders of fitted tables, are left
    out, so two fits on the same rows give the same report.
    """
    rows = [
        (position, type(stage).__name__, param.name, str(value))
        for position, stage in enumerate(model.stages)
        for param, value in stage.extractParamMap().items()
        if stage.uid not in str(value) and param.name != "tablePath"
    ]
    return spark.createDataFrame(rows, "position int, stage string, param string, value string")
