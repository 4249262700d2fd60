"""Columns of the user beside those that a step adds."""

from pyspark.sql import functions as F

from trainflow.functions.names import free
from trainflow.operators.ranking import numbered


def test_free_names():
    assert free(["a", "__D", "__d_"], "__d", "x", "x", "A") == ["__d__", "x", "x_", "A_"]


def test_numbering_keeps_columns_with_its_own_names(spark):
    names = ["__piece", "__size", "__group", "__of", "__start", "__place"]
    rows = spark.range(50).select((F.col("id") % 3).alias("g"), "id", *(F.col("id").alias(n) for n in names))
    found = numbered(rows, "g", [F.col("id")], "n").collect()
    assert all(r["n"] == r["id"] // 3 and all(r[n] == r["id"] for n in names) for r in found)
    assert found[0].asDict().keys() == {"g", "id", "n", *names}
