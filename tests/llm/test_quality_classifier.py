"""The factorisation machine: its identity, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trainflow.llm import quality
from trainflow.llm.catalog import op1_quality_classifier

FOLDER = "/root/testdata/sf0.01"


def test_linear_time_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    k = len(quality.STATISTICS)
    own = quality.Machine(
        0.3, rng.normal(size=quality.SLOTS + k), rng.normal(size=(quality.SLOTS + k, quality.RANK)), np.zeros(k), np.ones(k)
    )
    x = quality.inputs([b"some few words, Some more!", b"", None, "é 12".encode()], np.array([5.0, np.nan, 0, 4]))
    for i, score in enumerate(own.score(x)):
        _, column, value = own.rows(x, np.array([i]))
        raw = own.bias + sum(own.weight[c] * v for c, v in zip(column, value, strict=True))
        for a in range(len(column)):
            for b in range(a + 1, len(column)):
                raw += own.vector[column[a]] @ own.vector[column[b]] * value[a] * value[b]
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def test_inputs_of_a_text():
    text = "Aa aa b1!\n\nÉ aa"
    x = quality.inputs([text.encode()], np.array([float(len(text))]))
    got = dict(zip(quality.STATISTICS, x.statistics[0], strict=True))
    assert len(x.slots) == 3 and np.isclose((x.weights**2).sum(), 1)
    assert got["log_words"] == pytest.approx(np.log1p(5)) and got["distinct_words"] == pytest.approx(3 / 5)
    assert got["upper"] == pytest.approx(1 / 7) and got["top_word"] == pytest.approx(3 / 5)
    assert got["repeated_word"] == pytest.approx(1 / 5) and got["length_gap"] == 0 and got["distinct_lines"] == 1


def test_held_out_accuracy(spark):
    rows = op1_quality_classifier(spark, FOLDER).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    checked = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(checked) > 80 and np.mean([p == q for p, q in checked]) > 0.95


def test_labels_held_out_are_never_learned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels, most=100), quality.train(docs, turned, most=100)
    assert a.bias == b.bias and (a.weight == b.weight).all() and (a.vector == b.vector).all()


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", 0), (3, "word " * 50_000, -5), (3, "word", 4), (None, "x", 1), (5, "\n\n", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "'a' as slots")
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (3, 1), (3, 1), (3, 0), (5, None), (None, 1), (5, 9), (6, 1)], "doc_id long, quality int"
    )
    machine = quality.train(docs, labels)
    found = quality.scored(docs, machine)
    assert found.columns == ["doc_id", "text", "n_chars", "slots", "score"]
    assert all(0 <= r.score <= 1 for r in found.collect()) and found.count() == 6


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 3)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.scored(docs, quality.train(docs, labels)).collect()] == [0.5]
    assert quality.scored(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0
