import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trainflow.operators import frequency, lookup
from trainflow.operators.ranking import numbered
from trainflow.operators.stages import FrequencyEncoder
from trainflow.workspace import written


def test_mode_ties_go_to_the_smaller_value_and_empty_columns_have_none(spark):
    df = spark.createDataFrame([("b", None, "x"), ("a", None, "y"), ("b", None, "y"), ("a", None, None), (None, None, None)], "t string, e string, m string")
    assert frequency.mode_values(df, ["t", "e", "m"]) == {"t": "a", "e": None, "m": "y"}
    filled = frequency.fill_with(df, {"t": "a", "e": None}).select("im_t", "im_e").collect()
    assert [r.im_t for r in filled] == ["b", "a", "b", "a", "a"]
    assert [r.im_e for r in filled] == [None] * 5


def test_modes_of_all_columns_take_one_job_set(spark, jobs):
    one = spark.range(50).selectExpr("cast(id % 3 as string) AS a")
    many = spark.range(50).selectExpr(*[f"cast(id % {i + 2} as string) AS c{i}" for i in range(8)])
    assert jobs(lambda: frequency.mode_values(one, one.columns), "one mode") == jobs(
        lambda: frequency.mode_values(many, many.columns), "eight modes"
    )


def test_means_leave_out_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (3.0, None)], "x double, y double")
    assert frequency.means(df, ["x", "y"]) == {"x": 2.0, "y": None}
    assert [r.im_x for r in frequency.fill_means(df, {"x": 2.0}).collect()] == [1.0, 2.0, 2.0, 3.0]


def test_class_distribution_orders_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "y string")
    assert [tuple(r) for r in frequency.class_distribution(df, "y").collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_category_index_ranks_by_count_then_value(spark):
    df = spark.createDataFrame([("c",), ("c",), ("b",), ("A",), ("a",), (None,)], "v string")
    index = frequency.category_index(frequency.value_counts(df, ["v"]))
    assert [r.value for r in index.orderBy("idx").collect()] == ["c", "A", "a", "b"]


def test_numbering_in_pieces_equals_sorting_whole_groups(spark):
    rng = random.Random(7)
    data = [(g, v) for g, size in (("hot", 600), ("small", 5), ("one", 1)) for v in rng.sample(range(10_000), size)]
    df = spark.createDataFrame(data, "g string, v int").repartition(5)
    found = {(r.g, r.v): r.n for r in numbered(df, "g", [F.desc("v")], "n").collect()}
    expected = {}
    for group in {g for g, _ in data}:
        ordered = sorted((v for g, v in data if g == group), reverse=True)
        expected.update({(group, v): i for i, v in enumerate(ordered)})
    assert found == expected


def test_one_hot_drops_the_last_category_and_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, "z")], "k int, c string")
    index = written(frequency.category_index(frequency.value_counts(df, ["c"])), "index")
    slots = frequency.one_hot_slots(df, ["k"], index, ["c"]).collect()
    assert {(r.k, r.column, r.slot) for r in slots} == {(1, "c", 0), (2, "c", 0), (3, "c", 1)}


@pytest.fixture(params=["broadcast", "hot and cold", "cold only"])
def sizes(request, monkeypatch):
    if request.param != "broadcast":
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(lookup, "HOT_PARTS", 5 if request.param == "hot and cold" else 1)
        monkeypatch.setattr(lookup, "SALTS", 7)
    return request.param


def test_frequency_encoding_is_the_same_on_every_path(spark, sizes):
    values = ["hot"] * 40 + ["warm"] * 25 + [f"v{i % 9}" for i in range(30)] + [None] * 15
    train = spark.createDataFrame([(v,) for v in values], "c string")
    score_values = values + ["unseen"] * 3
    score = spark.createDataFrame(list(enumerate(score_values)), "k int, c string")
    table = written(frequency.frequency_table(train, "c", "n"), "frequencies")
    counts = Counter(values)
    expected = {k: counts[v] if v is not None else 0 for k, v in enumerate(score_values)}
    left = frequency.frequency_encode(score, "c", table, "n", "left")
    assert left.columns == ["k", "c", "n"]
    assert {r.k: r.n for r in left.collect()} == expected
    assert left.count() == len(score_values)
    inner = frequency.frequency_encode(score, "c", table, "n", "inner")
    known = {k: n for k, n in expected.items() if score_values[k] is not None and score_values[k] != "unseen"}
    assert {r.k: r.n for r in inner.collect()} == known


def test_answered_rows_are_spread_over_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "HOT_PARTS", 5)
    rows = spark.range(300).selectExpr("id", "CASE WHEN id < 100 THEN 'hot' ELSE cast(id as string) END AS c")
    table = written(frequency.frequency_table(rows, "c", "n"), "frequencies")
    assert lookup.table_size(table, "value", "n") == lookup.TableSize(201, 3 + 3 + 200 * 3 + 200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        encoded = frequency.frequency_encode(rows, "c", table, "n")
        plan = encoded._jdf.queryExecution().toString()
        assert re.search(r"hashpartitioning\(__lk_row#\d+, __lk_salt#\d+", plan)
        assert {r.c: r.n for r in encoded.where("id < 101").collect()} == {"hot": 100, "100": 1}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_rejects_other_joins(spark):
    df = spark.range(1).selectExpr("id", "id AS n")
    with pytest.raises(ValueError, match="left or inner"):
        lookup.lookup(df, F.col("id"), df, "id", {"n": "n"}, how="full")


@pytest.mark.parametrize("key", ["unseen", "known", "known" * 2000])
def test_no_task_gets_much_more_than_the_mean(spark, monkeypatch, key):
    """Half of all rows under one key, also one the table lacks and one of several thousand bytes."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    rows = spark.range(60_000).withColumn("c", F.when(F.col("id") % 2 == 0, key).otherwise(F.col("id").cast("string")))
    table = written(spark.range(1, 60_000, 2).select(F.col("id").cast("string").alias("v"), F.lit(1).alias("n")), "t")
    if key != "unseen":
        table = written(table.unionByName(spark.range(1).select(F.lit(key).alias("v"), F.lit(2).alias("n"))), "t")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = lookup.lookup(rows, F.col("c"), table, "v", {"n": "n"})
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 60_000 and max(sizes) <= 2 * 60_000 / 16
    assert found.where("n IS NULL").count() == (30_000 if key == "unseen" else 0)


def test_names_of_the_table_do_not_clash(spark, monkeypatch):
    for rows_limit in (lookup.BROADCAST_ROWS, 0):
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", rows_limit)
        df = spark.createDataFrame([(1, "a", 5, "x"), (2, "b", 6, "y"), (3, None, 7, "a")], "cnt int, `a.b` string, value int, `__text` string")
        model = FrequencyEncoder(inputCols=["a.b", "__text"], outputCols=["fe", "cnt"]).fit(df)
        found = model.transform(df)
        assert found.columns == ["a.b", "value", "__text", "fe", "cnt"]
        assert sorted((r["value"], r.fe, r.cnt) for r in found.collect()) == [(5, 1.0, 1.0), (6, 1.0, 1.0), (7, 0.0, 1.0)]


def _plain_modes(spark, df, columns):
    return sorted(map(tuple, frequency.modes(df, columns).collect()))


def _candidate_modes(df, columns):
    return sorted(map(tuple, frequency.modes_by_candidates(df, columns).collect()))


def test_modes_by_candidates_equal_modes(spark):
    """Clear modes, ties, nearly unique and unique columns, nulls, long values and odd names."""
    df = spark.range(20_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'often' ELSE concat('v', id) END AS clear",
        "CASE WHEN id IN (7, 9000) THEN 'twice' ELSE concat('v', id) END AS rare",
        "CASE WHEN id IN (7, 9000) THEN 'b' WHEN id IN (8, 9001) THEN 'a' ELSE concat('v', id) END AS tie",
        "id AS unique_id",
        "CASE WHEN id % 2 = 0 THEN repeat(cast(id % 5 AS string), 5000) END AS `lo.ng`",
        "cast(NULL AS string) AS nothing",
        "id % 20 AS even_spread",
    )
    assert _candidate_modes(df, df.columns) == _plain_modes(spark, df, df.columns)
    assert _candidate_modes(df.limit(0), df.columns) == [] == _candidate_modes(df, [])


def test_candidates_are_only_a_hint(spark, monkeypatch):
    """With a sketch far too small for the values the result is the same."""
    monkeypatch.setattr(frequency, "CANDIDATES", 1)
    monkeypatch.setattr(frequency, "TRACKED", 1)
    monkeypatch.setattr(frequency, "GROUPS", 3)
    df = spark.range(3_000).selectExpr("pmod(hash(id), 700) AS a", "least(id % 100, 97) AS b")
    assert _candidate_modes(df, ["a", "b"]) == _plain_modes(spark, df, ["a", "b"])


def test_a_clear_mode_counts_no_other_value(spark, monkeypatch):
    tables = {}

    def kept(df, name):
        tables[name] = df.collect()
        return df

    monkeypatch.setattr(frequency, "written", kept)
    df = spark.range(50_000).selectExpr("CASE WHEN id % 4 = 0 THEN 'often' ELSE concat('v', id) END AS x")
    assert _candidate_modes(df, ["x"]) == [("x", "often", 12_500)]
    assert tables["mode-groups"] == []
    assert len(tables["mode-candidates"]) <= frequency.GROUPS + frequency.CANDIDATES
