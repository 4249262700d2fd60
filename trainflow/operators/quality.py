"""Data quality: missing values, column profiles, required columns, quarantine."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainflow.functions import missing_percentage
from trainflow.spec import HIGH_MISSING_REASON

ERROR_COLUMN = "error_msg"
ACCEPTED_COLUMN = "accepted"


def quoted(name: str) -> Column:
    """Column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_row"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of nulls of every column, counted in one pass."""
    names = list(columns or df.columns)
    return df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in names])


def missing_report(df: DataFrame) -> DataFrame:
    """One row per column: ``column, total_row, missing_row, missing_percentage``.

    One aggregation over the table for all columns; the percentage is null for an empty table.
    """
    names = df.columns
    filled = [F.count(quoted(c)).alias(f"filled_{i}") for i, c in enumerate(names)]
    counted = df.agg(F.count(F.lit(1)).alias("total_row"), *filled)
    entries = [
        F.struct(F.lit(c).alias("column"), (F.col("total_row") - F.col(f"filled_{i}")).alias("missing_row"))
        for i, c in enumerate(names)
    ]
    return counted.select("total_row", F.explode(F.array(*entries)).alias("entry")).select(
        "entry.column",
        "total_row",
        "entry.missing_row",
        missing_percentage(F.col("entry.missing_row"), F.col("total_row")).alias("missing_percentage"),
    )


def high_missing_columns(report: DataFrame, max_missing_percent: float) -> DataFrame:
    """Rows of a missing report whose share of nulls is above the limit."""
    return report.where(F.col("missing_percentage") > F.lit(float(max_missing_percent)))


def unwanted_columns(
    df: DataFrame, max_missing_percent: float, always_drop: Iterable[str] = (), keep: Iterable[str] = ()
) -> list[str]:
    """Names to drop, in table order: too many nulls, or always unwanted and present.

    Columns in ``keep`` (the row key) are never dropped.
    """
    report = high_missing_columns(missing_report(df), max_missing_percent)
    # The report has one row per column of the table, whatever the number of rows.
    names = {row["column"] for row in report.select("column").collect()}
    names |= set(always_drop)
    return [c for c in df.columns if c in names and c not in set(keep)]


def split_columns(
    df: DataFrame, unwanted: Sequence[str], key: Sequence[str], reason: str = HIGH_MISSING_REASON
) -> tuple[DataFrame, DataFrame]:
    """The table without the unwanted columns, and those columns with key and reason."""
    rejected = [c for c in unwanted if c in df.columns and c not in key]
    quarantined = df.select(*map(quoted, [*key, *rejected]), F.lit(reason).alias(ERROR_COLUMN))
    return df.drop(*rejected), quarantined


def known_target(target: str, unknown: str) -> Column:
    """True for rows with a usable target: neither null nor the mark for unknown."""
    return F.coalesce(quoted(target) != F.lit(unknown), F.lit(False))


def with_verdict(df: DataFrame, accept: Column, reason: str) -> DataFrame:
    """Every row with ``accepted`` and, where rejected, ``error_msg``. A null verdict rejects."""
    verdict = F.coalesce(accept, F.lit(False))
    return df.withColumns({ACCEPTED_COLUMN: verdict, ERROR_COLUMN: F.when(~verdict, F.lit(reason))})


def accepted_rows(df: DataFrame, accept: Column) -> DataFrame:
    return df.where(F.coalesce(accept, F.lit(False)))


def rejected_rows(df: DataFrame, accept: Column, reason: str) -> DataFrame:
    """Rows which do not pass, nulls included, with the reason."""
    return df.where(~F.coalesce(accept, F.lit(False))).withColumn(ERROR_COLUMN, F.lit(reason))


def missing_required(columns: Iterable[str], required: Sequence[str]) -> list[str]:
    present = set(columns)
    return [c for c in required if c not in present]


def check_required(df: DataFrame, required: Sequence[str]) -> None:
    """Raise if a required column is absent."""
    absent = missing_required(df.columns, required)
    if absent:
        raise ValueError(f"required columns missing: {absent}; found: {df.columns}")


def required_column_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: is it there, and how many values are filled."""
    present = [c for c in required if c in df.columns]
    counts = [F.count(quoted(c)).alias(f"filled_{i}") for i, c in enumerate(present)]
    counted = df.agg(F.count(F.lit(1)).alias("total_row"), *counts)
    filled = {c: F.col(f"filled_{i}") for i, c in enumerate(present)}
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(c in filled).alias("present"),
            filled.get(c, F.lit(None).cast("long")).alias("filled_row"),
        )
        for c in required
    ]
    return counted.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: ``column, n_unique, n_missing, missing_percentage``; null is a value.

    ``exact=False`` swaps the distinct counts for sketches of fixed size in a single pass.
    """
    names = df.columns
    if not exact:
        sketches = [
            F.struct(
                F.lit(c).alias("column"),
                (
                    F.approx_count_distinct(quoted(c))
                    + F.coalesce(F.max(quoted(c).isNull().cast("long")), F.lit(0))
                ).alias("n_unique"),
                F.count_if(quoted(c).isNull()).alias("n_missing"),
            ).alias(f"entry_{i}")
            for i, c in enumerate(names)
        ]
        counted = df.agg(F.count(F.lit(1)).alias("total"), *sketches)
        entries = F.array(*[F.col(f"entry_{i}") for i in range(len(names))])
        per_column = counted.select("total", F.explode(entries).alias("entry")).select("total", "entry.*")
    else:
        # Counting each value first makes the second grouping add up partial counts only. Long
        # texts are told apart by their SHA-256 digest, so that no text is shuffled.
        short = F.when(F.octet_length("value") > 64, F.sha2("value", 256)).otherwise(F.col("value"))
        per_column = (
            value_rows(df, names)
            .groupBy("column", short.alias("value"))
            .agg(F.count(F.lit(1)).alias("cnt"))
            .groupBy("column")
            .agg(
                F.sum("cnt").alias("total"),
                F.count(F.lit(1)).alias("n_unique"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("cnt"))), F.lit(0).cast("long")).alias(
                    "n_missing"
                ),
            )
        )
    return per_column.select(
        "column",
        "n_unique",
        "n_missing",
        missing_percentage(F.col("n_missing"), F.col("total")).alias("missing_percentage"),
    )


def value_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form: one ``column, value`` row per cell, values as text."""
    cells = [F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns]
    kind = "array<struct<column:string,value:string>>"  # also with no columns at all
    return df.select(F.explode(F.array(*cells).cast(kind)).alias("cell")).select("cell.column", "cell.value")
