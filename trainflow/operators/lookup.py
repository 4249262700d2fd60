"""Join rows to a table that has one row per key, safe for hot keys."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainflow.operators.quality import quoted
from trainflow.workspace import written

# Sizes up to which a table, with its values, is sent to every executor. Beyond, rows are shuffled;
# the result is the same.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
# A key is hot if more than one part in HOT_PARTS of the rows carries it: fewer than HOT_PARTS keys
# can, and 8 bytes of each are broadcast. Its rows are spread over SALTS places.
HOT_PARTS = 1_000
SALTS = 256


@dataclass(frozen=True)
class TableSize:
    rows: int
    bytes: int

    @property
    def small(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES


def table_size(table: DataFrame, *columns: str) -> TableSize:
    """Measured size of the columns of a lookup table: one small aggregation."""
    width = sum((F.coalesce(F.octet_length(quoted(c).cast("string")), F.lit(0)) for c in columns), F.lit(0))
    row = table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return TableSize(row["rows"], row["bytes"])


def hashable(df: DataFrame) -> list[Column]:
    """Columns that Spark can hash."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [quoted(name) for name, kind in kinds.items() if "map<" not in kind and "variant" not in kind]


def lookup(
    rows: DataFrame,
    row_key: Column,
    table: DataFrame,
    table_key: str,
    values: Mapping[str, str],
    how: str = "left",
    size: TableSize | None = None,
) -> DataFrame:
    """Add columns of ``table`` to each row by ``row_key``; ``values`` maps them to their new names.

    A column of the rows with a new name is replaced. A small table is broadcast. Otherwise both sides
    are shuffled by key, and the keys that are hot among the *rows*, whether the table has them or not,
    by key and salt: the rows by their content and the task they come from, so that copies part too and
    a retried task sends each row to the same place; the table's row goes to every salt. No task gets
    more than one cold key's share and a part of the hot ones. ``how`` is ``left`` or ``inner``. Null
    keys never match; their rows are spread as well.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    size = size or table_size(table, table_key, *values)
    kept = [c for c in rows.columns if c not in values.values()]
    found = [F.col(f"__lk_{i}").alias(name) for i, name in enumerate(values.values())]
    side = table.select(quoted(table_key).alias("__lk_key"), *(quoted(c).alias(f"__lk_{i}") for i, c in enumerate(values)))
    keyed = rows.withColumn("__lk_row", row_key)
    if size.small:
        joined = keyed.join(F.broadcast(side), F.col("__lk_row") == F.col("__lk_key"), how)
        return joined.select(*map(quoted, kept), *found)

    counts = written(keyed.groupBy(F.xxhash64("__lk_row").alias("__lk_hot")).agg(F.count(F.lit(1)).alias("n")), "keys")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(counts.where(F.col("n") * HOT_PARTS > F.lit(total)).select("__lk_hot"))
    # A salt is never a literal: the optimizer would fold that into a filter and shuffle by key alone.
    spread = F.lit(1) + F.pmod(F.xxhash64(*hashable(rows), F.spark_partition_id()), F.lit(SALTS)).cast("int")
    marked = keyed.join(hot, F.xxhash64("__lk_row") == F.col("__lk_hot"), "left")
    salt = F.when(F.col("__lk_hot").isNotNull() | F.col("__lk_row").isNull(), spread).otherwise(F.lit(0))
    salts = F.when(F.col("__lk_hot").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.lit(SALTS)))
    answers = side.where(F.col("__lk_key").isNotNull()).join(hot, F.xxhash64("__lk_key") == F.col("__lk_hot"), "left")
    answers = answers.withColumn("__lk_place", F.explode(salts)).drop("__lk_hot")
    both = marked.withColumn("__lk_salt", salt).join(
        answers, (F.col("__lk_row") == F.col("__lk_key")) & (F.col("__lk_salt") == F.col("__lk_place")), how
    )
    return both.select(*map(quoted, kept), *found)
