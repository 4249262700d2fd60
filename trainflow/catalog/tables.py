"""The test tables and the case records made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainflow.spec import FeatureSpec


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """One case record per order.

    Values go missing where an order was never shipped, and where the amount is small (no priority
    taken) or large (no segment asked). ``sparse_note`` is mostly empty.
    """
    shipped = (
        load(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("first_ship"), F.min("l_partkey").alias("partkey"))
    )
    orders = load(spark, folder, "orders")
    customer = load(spark, folder, "customer")
    part = load(spark, folder, "part")
    joined = (
        orders.join(shipped, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(part, F.col("p_partkey") == F.col("partkey"), "left")
    )
    return joined.select(
        F.col("o_orderkey").alias("case_id"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_totalprice") <= 475000, F.col("c_mktsegment")).alias("segment"),
        F.col("p_type").alias("channel"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("sparse_note"),
        F.col("o_orderdate").alias("opened_at"),
        F.col("first_ship").alias("sent_at"),
        F.col("p_name").alias("subject"),
        F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") == "P", "N/A")
        .when(F.col("o_orderstatus") == "F", "Yes")
        .otherwise("No")
        .alias("outcome"),
    )


CASES = """
cases AS (
  SELECT o.o_orderkey AS case_id,
         CASE WHEN o.o_totalprice >= 50000 THEN o.o_orderpriority END AS priority,
         CASE WHEN o.o_totalprice <= 475000 THEN c.c_mktsegment END AS segment,
         p.p_type AS channel,
         CASE WHEN o.o_orderstatus = 'O' THEN o.o_orderpriority END AS sparse_note,
         o.o_orderdate AS opened_at,
         s.first_ship AS sent_at,
         p.p_name AS subject,
         o.o_totalprice AS amount,
         CASE o.o_orderstatus WHEN 'P' THEN 'N/A' WHEN 'F' THEN 'Yes' ELSE 'No' END AS outcome
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, min(l_partkey) AS partkey
             FROM lineitem GROUP BY 1) s ON s.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN part p ON p.p_partkey = s.partkey)
"""

CASE_COLUMNS = [
    "case_id",
    "priority",
    "segment",
    "channel",
    "sparse_note",
    "opened_at",
    "sent_at",
    "subject",
    "amount",
    "outcome",
]

CASE_SPEC = FeatureSpec(
    target="outcome",
    key=("case_id",),
    categorical=("priority", "segment", "channel"),
    date_pairs=(("sent_at", "opened_at", "diff_in_days"),),
    text="subject",
    always_drop=("sub_product", "narrative"),
)

DOCUMENT_SPEC = FeatureSpec(
    target="quality",
    key=("doc_id",),
    categorical=("lang",),
    frequency=("source",),
    numeric=("n_chars",),
    text="text",
)


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their quality label as text."""
    labels = load(spark, folder, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    return load(spark, folder, "documents").join(labels, "doc_id")


def per_column(template: str, columns: list[str]) -> str:
    """SQL for one column, repeated for several and put together with UNION ALL."""
    return "\nUNION ALL\n".join(template.format(c=c) for c in columns)
