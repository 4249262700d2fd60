"""A corpus from raw documents to packed sequences.

Each stage takes the documents its predecessor kept. All but the last return the columns of the table
they are given: a filter leaves rows as they are, line dedup changes ``text`` and sets ``n_chars`` of
changed texts. The last returns the packed pieces. Null texts have no words or lines; they are scored
on their statistics, linked with other documents without words, never contaminated, and packed as an
end id. Repeated rows are near-duplicates of each other. Empty tables go through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainflow.catalog.tables import load
from trainflow.functions.names import free
from trainflow.llm import decontaminate, line_dedup, packing, quality, simhash
from trainflow.llm.catalog import byte_bpe
from trainflow.workspace import written

#: Whole texts that a Python worker gets at once: they stay small beside an executor's heap.
ROWS_AT_ONCE = 1_000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives a score of at least one half."""
    _small_batches(spark)
    machine = quality.train(docs, load(spark, sf_dir, "labels"))
    (score,) = free(docs.columns, "__score")
    return quality.scored(docs, machine, name=score).where(F.col(score) >= 0.5).drop(score)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document, or place, has as well or nearly so."""
    lines, removed = free(docs.columns, "__n_lines", "__n_removed")
    kept = line_dedup.deduplicated(docs, counts=(lines, removed))
    size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    n_chars = F.when(F.col(removed) > 0, size).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    _small_batches(spark)
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark passages."""
    _small_batches(spark)
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 ids."""
    _small_batches(spark)
    return packing.pack(docs, byte_bpe(), end=2, size=1024, as_text=False)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", packed_sequences),
]

#: No SQL engine encodes tokens or trains the classifier; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each stage's result is a table that the next one reads."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
