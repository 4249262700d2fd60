"""Acceptance of a newly trained model against the best one so far."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainflow.operators.metrics import metric_row
from trainflow.operators.quality import quoted

CHALLENGER = "challenger"
CHAMPION = "champion"


def two_model_counts(df: DataFrame, label: str, challenger: str, champion: str) -> DataFrame:
    """Confusion counts of two models scored on the same rows: ``model, label, prediction, cnt``.

    The rows are grouped once by label and both predictions; only the groups are taken apart.
    """
    groups = df.groupBy(
        quoted(label).alias("label"), quoted(challenger).alias("challenger"), quoted(champion).alias("champion")
    ).agg(F.count(F.lit(1)).alias("cnt"))
    sides = F.array(
        F.struct(F.lit(CHALLENGER).alias("model"), F.col("challenger").alias("prediction")),
        F.struct(F.lit(CHAMPION).alias("model"), F.col("champion").alias("prediction")),
    )
    return (
        groups.select("label", "cnt", F.explode(sides).alias("side"))
        .select("side.model", "label", "side.prediction", "cnt")
        .where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
        .groupBy("model", "label", "prediction")
        .agg(F.sum("cnt").alias("cnt"))
    )


def decide(counts: DataFrame, min_gain: float, min_f1: float | None = None) -> DataFrame:
    """One row: F1 of both models, the change, and whether the challenger is accepted.

    Without champion rows the challenger is accepted with a change of 0. ``min_f1`` is an optional
    floor for the challenger itself.
    """
    scores = metric_row(counts, by=["model"])

    def of(model: str):
        return F.max(F.when(F.col("model") == model, F.col("f1")))

    pair = scores.agg(of(CHALLENGER).alias("f1_challenger"), of(CHAMPION).alias("f1_champion"))
    change = F.when(F.col("f1_champion").isNull(), F.lit(0.0)).otherwise(
        F.col("f1_challenger") - F.col("f1_champion")
    )
    better = F.col("f1_champion").isNull() | (F.col("changed_accuracy") >= F.lit(min_gain))
    good = F.lit(True) if min_f1 is None else F.col("f1_challenger") >= F.lit(min_f1)
    return (
        pair.where(F.col("f1_challenger").isNotNull())
        .withColumn("changed_accuracy", change)
        .withColumn("model_accepted", better & good)
        .withColumn("active", F.col("model_accepted"))
    )
