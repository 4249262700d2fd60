"""Scaling numeric columns to unit standard deviation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainflow.operators.quality import quoted


def deviations(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Sample standard deviation of each column in one pass; 0 where it is not defined."""
    row = df.agg(*[F.stddev_samp(quoted(c).cast("double")).alias(c) for c in columns]).first()
    return {c: row[c] or 0.0 for c in columns}


def scale(df: DataFrame, by: dict[str, float], prefix: str = "scaled_") -> DataFrame:
    """Divide each column by its deviation, without centring; a constant column becomes 0."""
    factors = {c: (1.0 / d if d else 0.0) for c, d in by.items()}
    return df.withColumns({prefix + c: quoted(c).cast("double") * F.lit(f) for c, f in factors.items()})
