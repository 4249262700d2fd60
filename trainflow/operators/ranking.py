"""Row numbers for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trainflow.functions.names import free
from trainflow.workspace import written

def numbered(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows of each group from 0 in the given (unique) order.

    A plain ``row_number`` sorts a whole group in one task. Here the rows are range partitioned
    by group and order, each piece is numbered alone, and the sizes of the earlier pieces of the
    same group are added. The pieces are stored, so both steps see the same layout.
    """
    piece, size, other, of, begin, place = free([*df.columns, name], "__piece", "__size", "__group", "__of", "__start", "__place")
    pieces = written(df.repartitionByRange(F.col(group), *order).withColumn(piece, F.spark_partition_id()), "numbered")
    earlier = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and range partition.
    starts = (
        pieces.groupBy(group, piece)
        .agg(F.count(F.lit(1)).alias(size))
        .select(
            F.col(group).alias(other),
            F.col(piece).alias(of),
            F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(begin),
        )
    )
    inside = Window.partitionBy(group, piece).orderBy(*order)
    return (
        pieces.withColumn(place, F.row_number().over(inside) - 1)
        .join(starts, F.col(group).eqNullSafe(F.col(other)) & (F.col(piece) == F.col(of)))
        .drop(other, of)
        .withColumn(name, (F.col(place) + F.col(begin)).cast("long"))
        .drop(piece, place, begin)
    )
