"""Indexes whose labels stay a table, beside Spark's own on narrow columns."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from trainflow.operators import lookup
from trainflow.operators.stages import WideIndexer, WideIndexerModel


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.fixture(params=["broadcast", "shuffled"])
def way(request, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)


def frame(spark, n=600):
    """Ties in the counts, nulls, and half of the rows under one value."""
    return spark.range(n).selectExpr(
        "id",
        "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 9 = 0 THEN NULL ELSE concat('v', id % 31) END AS `a.b`",
        "cast(id % 4 AS int) AS number",
    )


def test_same_slots_as_string_indexer(spark, way):
    df = frame(spark).withColumnRenamed("a.b", "a")
    unseen = spark.createDataFrame([(-1, "never seen", 77), (-2, "", None)], "id long, a string, number int")
    asked = df.unionByName(unseen)
    model = WideIndexer(inputCols=["a", "number"], outputCols=["ai", "ni"]).fit(df)
    ours = PipelineModel(stages=[model, model.one_hot(spark, ["av", "nv"])]).transform(asked)
    indexer = StringIndexer(inputCols=["a", "number"], outputCols=["ai", "ni"], handleInvalid="keep").fit(df)
    theirs = indexer.transform(asked)
    theirs = OneHotEncoder(inputCols=["ai", "ni"], outputCols=["av", "nv"]).fit(theirs).transform(theirs)
    wanted = ("id", "a", "ai", "ni", "av", "nv")
    assert rows_of(ours, *wanted) == rows_of(theirs, *wanted)
    assert model.categories() == {c: len(labels) for c, labels in zip(["a", "number"], indexer.labelsArray)}


def test_saved_model_and_odd_names(spark, tmp_path, way):
    df = frame(spark)
    model = WideIndexer(inputCols=["a.b"], outputCols=["idx"]).fit(df)
    model.write().save(str(tmp_path / "m"))
    loaded = WideIndexerModel.load(str(tmp_path / "m"))
    assert loaded.categories() == model.categories()
    assert rows_of(loaded.transform(df), "id", "idx") == rows_of(model.transform(df), "id", "idx")
    assert rows_of(loaded.labels(spark), "value", "idx") == rows_of(model.labels(spark), "value", "idx")


def test_no_rows_and_no_values(spark):
    df = frame(spark).withColumn("none", F.lit(None).cast("string"))
    model = WideIndexer(inputCols=["none"], outputCols=["i"]).fit(df)
    assert model.categories() == {"none": 0}
    assert {r.i for r in model.transform(df).collect()} == {0.0}
    assert WideIndexer(inputCols=["number"], outputCols=["i"]).fit(df.limit(0)).transform(df.limit(0)).collect() == []


def test_a_million_categories(spark):
    df = spark.range(1_200_000).selectExpr("id", "CASE WHEN id >= 1000000 THEN 'k0' ELSE concat('k', id) END AS k")
    model = WideIndexer(inputCols=["k"], outputCols=["i"]).fit(df)
    assert model.categories() == {"k": 1_000_000}
    found = PipelineModel(stages=[model, model.one_hot(spark, ["v"])]).transform(df)
    row = found.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("i").alias("d"),
        F.max("i").alias("last"),
        F.count_if((F.col("k") == "k0") & (F.col("i") == 0)).alias("hot"),
        F.count_if(F.col("v").cast("string") == F.concat(F.lit("(1000000,["), F.col("i").cast("int"), F.lit("],[1.0])"))).alias("v"),
    ).first()
    assert (row.n, row.d, row["last"], row.hot, row.v) == (1_200_000, 1_000_000, 999_999.0, 200_001, 1_200_000)


def test_the_driver_holds_no_name_of_a_slot(spark, tmp_path):
    from trainflow.operators.stages import WideOneHot

    df = frame(spark).withColumnRenamed("a.b", "a")
    model = WideIndexer(inputCols=["a", "number"], outputCols=["ai", "n.i"]).fit(df)
    model.setSizes([[2_000_000_000, 0], [4, 0]])
    stage = model.one_hot(spark, ["av", "n.v"])
    found = stage.transform(model.transform(df))
    assert found.schema["av"].metadata == {"ml_attr": {"num_attrs": 2_000_000_000}}
    row = found.where("id = 0").first()
    assert (row.av.size, list(row.av.indices), list(row["n.v"].indices)) == (2_000_000_000, [0], [0])
    stage.write().save(str(tmp_path / "s"))
    loaded = WideOneHot.load(str(tmp_path / "s"))
    assert rows_of(loaded.transform(model.transform(df)), "id", "av", "n.v") == rows_of(found, "id", "av", "n.v")


def test_an_index_outside_of_the_labels_has_no_slot(spark):
    from trainflow.operators.stages import WideOneHot

    df = spark.createDataFrame([(0.0,), (2.0,), (3.0,), (-1.0,), (None,)], "i double")
    found = WideOneHot(inputCols=["i"], outputCols=["v"], sizes=[3]).transform(df)
    assert [list(r.v.indices) for r in found.collect()] == [[0], [2], [], [], []]
    assert {r.v.size for r in found.collect()} == {3}
