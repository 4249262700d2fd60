"""Category counts, modes, category indexes, one-hot slots and frequency encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainflow.operators.lookup import lookup
from trainflow.operators.quality import quoted, value_rows
from trainflow.operators.ranking import numbered
from trainflow.workspace import written

#: Frequent values that are named beforehand per column, items of the sketch that names them, and groups of the others.
CANDIDATES, TRACKED, GROUPS = 16, 1024, 4096


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, cnt`` for several columns in one pass; null is a value of its own."""
    return value_rows(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def cardinality(counts: DataFrame) -> DataFrame:
    """``column, n_category`` from value counts."""
    return counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_category"))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per class, largest first, ties by name."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), target)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct()


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, cnt`` of the most frequent non-null value; a tie goes to the smaller value."""
    counts = (
        value_rows(df, columns)
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    best = F.min(F.struct((-F.col("cnt")).alias("less"), F.col("value").alias("value")))
    return (
        counts.groupBy("column")
        .agg(best.alias("best"))
        .select("column", "best.value", (-F.col("best.less")).alias("cnt"))
    )


def modes_by_candidates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The result of :func:`modes` without a shuffle of all values where a mode is clear.

    A sketch names candidates by their hash. One more pass counts them exactly, and all other values only
    in ``GROUPS`` groups of hashes: a value is not more frequent than its group. Values are counted one by one only in
    groups that reach the best candidate, so the result is exact whatever the sketch names. A column without a clear
    mode has all its groups counted, as in :func:`modes`. Reads ``df`` up to three times; write it first
    if it is costly. Nulls do not count, a tie goes to the smaller value, a column without values has no row.
    """
    names = list(columns)
    cells = value_rows(df, names).where(F.col("value").isNotNull()).withColumn("h", F.xxhash64("value"))
    sketch = F.expr(f"approx_top_k(h, {CANDIDATES}, {TRACKED})")
    # At most CANDIDATES numbers per column, whatever the number and the length of the values.
    named = {r["column"]: [x["item"] for x in r["top"]] for r in cells.groupBy("column").agg(sketch.alias("top")).collect()}
    if not named:
        return cells.select("column", "value", F.lit(0).cast("long").alias("cnt"))
    lists = F.create_map(*[x for c, top in named.items() for x in (F.lit(c), F.array(*map(F.lit, top)).cast("array<bigint>"))])
    # A column without candidates is absent from the map only if it has no values.
    is_candidate = F.array_contains(F.element_at(lists, F.col("column")), F.col("h"))
    group = F.pmod("h", F.lit(GROUPS)).cast("int")
    keyed = cells.select("column", F.when(is_candidate, F.col("value")).alias("value"), F.when(~is_candidate, group).alias("g"))
    counts = written(keyed.groupBy("column", "value", "g").agg(F.count(F.lit(1)).alias("cnt")), "mode-candidates")
    certain = counts.where(F.col("g").isNull()).select("column", "value", "cnt")
    best = certain.groupBy("column").agg(F.max("cnt").alias("best"))
    open_ = counts.where(F.col("g").isNotNull()).join(best, "column", "left")
    open_ = written(open_.where(F.col("cnt") >= F.coalesce("best", F.lit(0))).select("column", "g"), "mode-groups")
    if not open_.isEmpty():
        others = cells.where(~is_candidate).withColumn("g", group).join(open_, ["column", "g"], "left_semi")
        certain = certain.unionByName(others.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")))
    first = F.min(F.struct((-F.col("cnt")).alias("less"), F.col("value").alias("value")))
    found = certain.groupBy("column").agg(first.alias("first"))
    return found.select("column", "first.value", (-F.col("first.less")).alias("cnt"))


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Modes as a dict; None for a column without any value."""
    found = {row["column"]: row["value"] for row in modes(df, columns).collect()}
    return {c: found.get(c) for c in columns}


def fill_with(df: DataFrame, values: dict[str, object], prefix: str = "im_") -> DataFrame:
    """Copy each column to ``prefix`` + name with its nulls replaced; None leaves them."""
    copies = {prefix + c: quoted(c) for c in values}
    fills = {prefix + c: v for c, v in values.items() if v is not None}
    copied = df.withColumns(copies)
    return copied.na.fill(fills) if fills else copied


def means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Mean of each numeric column in one pass; null and NaN do not count."""
    row = df.agg(*[F.avg(F.nanvl(quoted(c).cast("double"), F.lit(None))).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def fill_means(df: DataFrame, values: dict[str, float | None], prefix: str = "im_") -> DataFrame:
    """Copy each numeric column with null and NaN replaced by the value learnt for it."""
    filled = {
        prefix + c: F.coalesce(F.nanvl(quoted(c).cast("double"), F.lit(None)), F.lit(v).cast("double"))
        for c, v in values.items()
    }
    return df.withColumns(filled)


def category_index(counts: DataFrame) -> DataFrame:
    """Add ``idx``: rank of each non-null value in its column, by count descending, then value.

    Works for any number of categories: no group is ranked in a single task.
    """
    return numbered(counts.where(F.col("value").isNotNull()), "column", [F.desc("cnt"), F.asc("value")], "idx")


def one_hot_slots(df: DataFrame, key: Sequence[str], index: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long one-hot form ``key, column, slot``; the last category of a column has no slot."""
    cells = [F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns]
    cell = F.concat("column", F.lit("\u0000"), "value").alias("cell")
    rows = df.select(*key, F.explode(F.array(*cells)).alias("c")).select(*key, "c.*").select(*key, "column", cell)
    last = index.groupBy("column").agg(F.max("idx").alias("last"))
    slots = (
        index.join(last, "column")
        .where(F.col("idx") < F.col("last"))
        .select(cell, F.col("idx").alias("slot"))
    )
    return lookup(rows, F.col("cell"), slots, "cell", {"slot": "slot"}, how="inner").select(*key, "column", "slot")


def frequency_table(df: DataFrame, column: str, output: str) -> DataFrame:
    """``value, output``: rows per value of one column, in the column's own type."""
    return df.groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias(output))


def frequency_encode(df: DataFrame, column: str, table: DataFrame, output: str, how: str = "left") -> DataFrame:
    """Add how often the row's value occurs in the table.

    ``left`` keeps every row and gives 0 to null and unseen values; ``inner`` drops those rows.
    """
    encoded = lookup(df, quoted(column), table, "value", {output: output}, how=how)
    return encoded.withColumn(output, F.coalesce(quoted(output), F.lit(0).cast("long")))
