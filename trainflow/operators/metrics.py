"""Classification metrics, all from one grouping by label and prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trainflow.operators.quality import quoted

# The metric names a report holds.
METRIC_NAMES = (
    "f1",
    "weightedPrecision",
    "weightedRecall",
    "weightedTruePositiveRate",
    "weightedFalsePositiveRate",
    "weightedFMeasure",
    "truePositiveRateByLabel",
    "falsePositiveRateByLabel",
    "precisionByLabel",
    "recallByLabel",
    "fMeasureByLabel",
)


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``by.., label, prediction, cnt``: the only pass over the scored rows.

    Rows without label or prediction count for nothing, as in the ML evaluator's input contract.
    """
    return (
        df.select(*by, quoted(label).alias("label"), quoted(prediction).alias("prediction"))
        .where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
        .groupBy(*by, "label", "prediction")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def class_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per class seen as label or prediction, from confusion counts.

    ``n`` rows with the label, ``p`` predicted so, ``tp`` both, ``total`` all rows. A class never
    predicted has precision 0, and an F measure of two zeros is 0.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("cnt")).otherwise(F.lit(0))
    zero = F.lit(0)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("cnt").alias("n"), zero.alias("p"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("class"), zero.alias("n"), F.col("cnt").alias("p"), zero.alias("tp")),
    )
    classes = (
        counts.select(*by, F.explode(sides).alias("side"))
        .select(*by, "side.*")
        .groupBy(*by, "class")
        .agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum("tp").alias("tp"))
    )
    # A window over one row per class, not over data rows.
    group = Window.partitionBy(*(by or [F.lit(1)]))
    n, p, tp, total = (F.col(c) for c in ("n", "p", "tp", "total"))
    rates = classes.withColumn("total", F.sum("n").over(group)).withColumns(
        {"precision": _ratio(tp, p), "recall": _ratio(tp, n), "false_positive_rate": _ratio(p - tp, total - n)}
    )
    precision, recall = F.col("precision"), F.col("recall")
    return rates.withColumn("f_measure", _ratio(precision * recall * 2.0, precision + recall))


def metric_row(counts: DataFrame, by: Sequence[str] = (), by_label: float | str = 0.0) -> DataFrame:
    """One row per ``by`` group with a column for every name in ``METRIC_NAMES``.

    ``by_label`` is the class of the five ``...ByLabel`` metrics.
    """
    share = F.col("n").cast("double") / F.col("total").cast("double")

    def weighted(column: str) -> Column:
        return F.sum(F.col(column) * share)

    if isinstance(by_label, str):
        chosen = F.col("class").cast("string") == F.lit(by_label)
    else:
        chosen = F.col("class").try_cast("double") == F.lit(float(by_label))

    def of_label(column: str) -> Column:
        return F.coalesce(F.max(F.when(chosen, F.col(column))), F.lit(0.0))

    columns = {
        "f1": weighted("f_measure"),
        "weightedPrecision": weighted("precision"),
        "weightedRecall": weighted("recall"),
        "weightedTruePositiveRate": weighted("recall"),
        "weightedFalsePositiveRate": weighted("false_positive_rate"),
        "weightedFMeasure": weighted("f_measure"),
        "truePositiveRateByLabel": of_label("recall"),
        "falsePositiveRateByLabel": of_label("false_positive_rate"),
        "precisionByLabel": of_label("precision"),
        "recallByLabel": of_label("recall"),
        "fMeasureByLabel": of_label("f_measure"),
    }
    aggregates = [columns[name].alias(name) for name in METRIC_NAMES]
    return class_metrics(counts, by).groupBy(*by).agg(*aggregates)


def metric_set(
    counts: DataFrame, by: Sequence[str] = (), by_label: float | str = 0.0, names: Sequence[str] = METRIC_NAMES
) -> DataFrame:
    """Long form of :func:`metric_row`: ``by.., metric, value``."""
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names]
    return (
        metric_row(counts, by, by_label)
        .select(*by, F.explode(F.array(*entries)).alias("entry"))
        .select(*by, "entry.metric", "entry.value")
    )


def metric(df: DataFrame, name: str, label: str, prediction: str) -> float | None:
    """A single metric of a scored table; None for a table without rows."""
    row = metric_row(confusion_counts(df, label, prediction)).select(name).first()
    return row[0] if row else None
