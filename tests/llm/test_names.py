"""Columns of the user that have the names of an operator's own."""

from trainflow.llm import decontaminate, simhash

NAMES = ["__d", "__x", "__met", "__row", "__word", "__bit", "__bits", "__digest", "__contaminated"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, *[f"v{i}"] * len(NAMES)) for i, t in enumerate(texts)], ["doc_id", "text", *NAMES])


def test_one_of_each(spark):
    found = sorted(simhash.one_of_each(frame(spark, ["one two three four", "one two three four", "five six"])).collect())
    assert [r["doc_id"] for r in found] == [0, 2] and all(r[n] == f"v{r['doc_id']}" for r in found for n in NAMES)


def test_clean(spark):
    words = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    found = sorted(decontaminate.clean(frame(spark, [words, "something else"]), items).collect())
    assert [r["doc_id"] for r in found] == [1] and all(r[n] == "v1" for r in found for n in NAMES)
