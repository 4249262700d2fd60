import math
from collections import Counter

import pytest
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from trainflow.functions import hash_bucket, largest_number, path_version, row_as_json, tokens
from trainflow.operators import text

TEXTS = [(1, "Red  Widget red"), (2, "blue widget"), (3, ""), (4, None), (5, " \tRED\nwidget ")]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(TEXTS, "k int, t string")


def words(t):
    return (t or "").lower().split()


def test_tokens_leave_out_blanks(documents):
    assert {r.k: r.w for r in documents.select("k", tokens("t").alias("w")).collect()} == {k: words(t) for k, t in TEXTS}


def test_tokens_are_the_tokenizers_words_without_blanks(documents):
    stage = Tokenizer(inputCol="t", outputCol="w").transform(documents.na.fill(""))
    kept = {r.k: [w for w in r.w if w] for r in stage.collect()}
    assert kept == {k: words(t) for k, t in TEXTS}


def test_tf_idf_against_brute_force(spark, documents):
    frequencies = text.document_frequency(documents, "t")
    df = Counter(w for _, t in TEXTS for w in set(words(t)))
    assert {r.term: r.df for r in frequencies.collect()} == df
    counts = text.term_counts(documents, ["k"], "t")
    assert {r.term: r.df for r in text.counted_frequency(counts).collect()} == df
    found = {(r.k, r.term): r.tfidf for r in text.tf_idf(counts, ["k"], frequencies, len(TEXTS)).collect()}
    expected = {
        (k, w): n * math.log((len(TEXTS) + 1) / (df[w] + 1)) for k, t in TEXTS for w, n in Counter(words(t)).items()
    }
    assert found == pytest.approx(expected)


def test_rare_words_weigh_nothing(spark):
    weights = spark.createDataFrame([(1,), (3,)], "df long").select(text.inverse_frequency(9, F.col("df"), 2).alias("w"))
    assert [r.w for r in weights.collect()] == [0.0, pytest.approx(math.log(10 / 4))]


def test_hashed_terms_keep_all_words(documents):
    counted = text.hashed_terms(documents, ["k"], "t", 3).groupBy("k").agg(F.sum("tf").alias("n"), F.max("slot").alias("s"))
    found = counted.collect()
    assert {r.k: r.n for r in found} == {k: len(words(t)) for k, t in TEXTS if words(t)}
    assert max(r.s for r in found) < 3


def test_buckets_do_not_depend_on_the_type_of_the_key(spark):
    row = spark.range(1).select(hash_bucket(F.lit(12), 97).alias("a"), hash_bucket(F.lit("12"), 97).alias("b")).first()
    assert row.a == row.b


def test_numbers_in_texts(spark):
    df = spark.createDataFrame([("a1/b22/c3",), ("none",), ("x99999999999999999999999y7",)], "s string")
    assert [r.n for r in df.select(largest_number("s").alias("n")).collect()] == [22, None, 7]
    paths = spark.createDataFrame([("k9/saved_models/17/model",), ("k9/other/17",), ("m/saved_models/8",)], "s string")
    assert [r.v for r in paths.select(path_version("s").alias("v")).collect()] == [17, None, 8]


def test_rows_as_json_leave_out_nulls(spark):
    df = spark.createDataFrame([(1, None, "ü\"")], "a int, b int, c string")
    assert df.select(row_as_json("a", "b", "c").alias("j")).first().j == '{"a":1,"c":"ü\\""}'


def test_words_of_single_texts_are_counted_without_a_shuffle(spark):
    rows = [(1, "b a b"), (2, "x"), (2, "x y"), (None, "a"), (None, "a a"), (3, None), (4, "")]
    found = text.term_counts(spark.createDataFrame(rows, "k int, t string"), ["k"], "t")
    wanted = {(1, "a"): 1, (1, "b"): 2, (2, "x"): 2, (2, "y"): 1, (None, "a"): 3}
    assert {(r.k, r.term): r.tf for r in found.collect()} == wanted
    single = text._counts_in_row(spark.createDataFrame(rows[:1], "k int, t string"), ["k"], "t")
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
    assert {(r.term, r.tf) for r in single.collect()} == {("a", 1), ("b", 2)}


@pytest.mark.parametrize("most", [0, 1, 3])
def test_frequent_words_are_broadcast_and_the_others_looked_up(spark, documents, monkeypatch, most):
    from trainflow.operators import lookup

    counts = text.term_counts(documents, ["k"], "t")
    frequencies = text.counted_frequency(counts)
    wanted = sorted(map(tuple, text.tf_idf(counts, ["k"], frequencies, 5).collect()))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", most)
    assert sorted(map(tuple, text.tf_idf(counts, ["k"], frequencies, 5).collect())) == wanted
