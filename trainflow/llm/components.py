"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainflow.workspace import written

ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(mark.cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every node that has a link; ``root`` is the smallest node reachable.

    Each round hangs the neighbours of a node on the smallest of them, first towards larger nodes,
    then towards smaller ones, until nothing changes: about log(n) rounds, also for long chains.
    A node's neighbours are never gathered: minima are aggregated, and the edges of a hot node are
    joined with one row, which Spark may split. Every round is a table in the shared folder. Links
    of a node with itself and links with a null end are ignored; no links give no rows.
    """
    a, b = F.col(left), F.col(right)
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = written(edges.distinct(), "edges")
    state = _state(edges)
    for _ in range(ROUNDS):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(moved.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
