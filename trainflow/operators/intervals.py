"""Calendar windows for incremental loads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainflow.functions import next_period_end, previous_period_end

# Spans longer than so many days are cut into years, months or weeks.
UNIT_LIMITS = ((365, "year"), (30, "month"), (7, "week"))


AUTO = "auto"


def interval_unit(start: date, end: date, unit: str | None = AUTO) -> str | None:
    """Period that cuts the span, by its length unless given; None for a span to stay whole."""
    if unit != AUTO:
        return unit
    days = (end - start).days
    return next((unit for limit, unit in UNIT_LIMITS if days > limit), None)


def interval_spine(spark: SparkSession, start: date, end: date, unit: str | None = AUTO) -> DataFrame:
    """Half-open windows ``window_start, window_end`` from ``start`` to ``end``, cut at period ends.

    One row per calendar period of the span. Equal dates give no window.
    """
    unit = interval_unit(start, end, unit)
    days = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("stop"))
    if start >= end:
        cuts = days.where(F.lit(False)).select("first", "stop", F.col("first").alias("window_start"))
    elif unit is None:
        cuts = days.select("first", "stop", F.col("first").alias("window_start"))
    else:
        every_day = F.explode(F.sequence("first", F.date_sub("stop", 1))).alias("window_start")
        cuts = days.select("first", "stop", every_day).where(
            (F.col("window_start") == F.col("first"))
            | (F.col("window_start") == previous_period_end("window_start", unit))
        )
    stop = F.col("stop") if unit is None else F.least("stop", next_period_end("window_start", unit))
    return cuts.select("window_start", stop.alias("window_end"))


def with_window(df: DataFrame, moment: str, start: date, end: date, unit: str | None = AUTO) -> DataFrame:
    """Rows inside the span with their window, found from the row's own date without a join."""
    unit = interval_unit(start, end, unit)
    first, stop = F.lit(start), F.lit(end)
    inside = slice_between(df, moment, start, end)
    day = F.col(moment).cast("date")
    if unit is None:
        return inside.withColumns({"window_start": first, "window_end": stop})
    return inside.withColumns(
        {
            "window_start": F.greatest(first, previous_period_end(day, unit)),
            "window_end": F.least(stop, next_period_end(day, unit)),
        }
    )


def rows_per_interval(df: DataFrame, moment: str, start: date, end: date, unit: str | None = AUTO) -> DataFrame:
    """``window_start, window_end, n_rows`` for every window, empty ones included."""
    placed = with_window(df, moment, start, end, unit)
    counts = placed.groupBy("window_start").agg(F.count(F.lit(1)).alias("n_rows"))
    spine = interval_spine(df.sparkSession, start, end, unit)
    return spine.join(counts, "window_start", "left").select(
        "window_start", "window_end", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows")
    )


def slice_between(df: DataFrame, moment: str, start: date, end: date) -> DataFrame:
    """Rows with ``start <= moment < end``; the bounds match the column type, so they reach the scan."""
    kind = df.schema[moment].dataType.simpleString()
    low, high = (F.lit(d.isoformat()).cast(kind) for d in (start, end))
    return df.where((F.col(moment) >= low) & (F.col(moment) < high))


def window_requests(spine: DataFrame, template: str) -> DataFrame:
    """One request per window: ``<fromdate>`` and ``<todate>`` of the template filled in."""
    text = F.replace(F.lit(template), F.lit("<fromdate>"), F.col("window_start").cast("string"))
    text = F.replace(text, F.lit("<todate>"), F.col("window_end").cast("string"))
    return spine.withColumn("request", text)
