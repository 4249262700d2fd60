"""Statistics kept per load beside those of the whole table."""

import math

import pytest
from pyspark.sql import functions as F

from trainflow.operators import frequency, quality, scaling
from trainflow.sources.files import delete
from trainflow.sources.ledger import Loads
from trainflow.sources.statistics import LoadStatistics, column_states


def part(spark, low, high):
    rows = spark.range(low, high).selectExpr(
        "id",
        "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 11 = 0 THEN double('NaN') ELSE 1e9 + id % 13 END AS price",
        "CASE WHEN id % 5 > 0 THEN concat('w', id % 37) END AS word",
        "date_add(date'2020-01-01', cast(id % 400 AS int)) AS day",
    )
    return rows


def by_column(rows, *fields):
    return {r["column"]: tuple(r[f] for f in fields) for r in rows.collect()}


def same_as_whole(stats, whole):
    got = by_column(stats.profile(), "n_unique", "n_missing", "missing_percentage")
    assert got == by_column(quality.column_profile(whole), "n_unique", "n_missing", "missing_percentage")
    counted = by_column(stats.missing_report(), "total_row", "missing_row")
    assert counted == by_column(quality.missing_report(whole), "total_row", "missing_row")
    numeric = ["id", "price"]
    assert stats.means(numeric) == pytest.approx(frequency.means(whole, numeric))
    finite = whole.withColumn("price", F.nanvl("price", F.lit(None)))
    assert stats.deviations(numeric) == pytest.approx(scaling.deviations(finite, numeric))


def test_three_loads_equal_the_whole_and_old_rows_are_not_read(spark, tmp_path):
    store = str(tmp_path / "store")
    stats, loads = LoadStatistics(spark, store), Loads(spark, store)
    bounds = [0, 500, 503, 1500]
    for i in range(3):
        load = loads.write(part(spark, bounds[i], bounds[i + 1]), name=f"n{i}")
        assert [x.name for x in stats.update()] == [f"n{i}"]
        # With its rows gone, a load can only be known by its state.
        delete(spark, f"{store}/{load.folder}")
        same_as_whole(stats, part(spark, 0, bounds[i + 1]))
    assert stats.update() == []
    assert {r.exact for r in stats.profile().collect()} == {True}


def test_a_repeated_load_replaces_its_statistics(spark, tmp_path):
    stats, loads = LoadStatistics(spark, str(tmp_path / "s")), Loads(spark, str(tmp_path / "s"))
    loads.write(part(spark, 0, 100), name="a")
    loads.write(part(spark, 100, 900), name="b")
    stats.update()
    loads.write(part(spark, 200, 300), name="b")
    with pytest.raises(LookupError, match="b"):
        stats.profile()
    assert [x.name for x in stats.update()] == ["b"]
    same_as_whole(stats, part(spark, 0, 100).union(part(spark, 200, 300)))
    loads.write(part(spark, 0, 0), name="b")
    stats.update()
    same_as_whole(stats, part(spark, 0, 100))


def test_no_loads_no_rows_and_no_columns(spark, tmp_path):
    stats = LoadStatistics(spark, str(tmp_path / "s"))
    assert stats.profile().collect() == [] and stats.means(["x"]) == {"x": None} and stats.deviations(["x"]) == {"x": 0.0}
    Loads(spark, str(tmp_path / "s")).write(part(spark, 0, 0))
    stats.update()
    rows = stats.profile().collect()
    assert {(r.n_unique, r.n_missing, r.missing_percentage) for r in rows} == {(0, 0, None)} and len(rows) == 4
    assert column_states(part(spark, 0, 3), []).collect() == []


def test_columns_that_some_loads_lack_or_type_otherwise(spark, tmp_path):
    stats, loads = LoadStatistics(spark, str(tmp_path / "s")), Loads(spark, str(tmp_path / "s"))
    loads.write(spark.createDataFrame([(1, 2.0), (2, None)], "id long, `a.b` double"))
    loads.write(spark.createDataFrame([("1",), ("x",), (None,)], "id string"))
    stats.update()
    got = by_column(stats.profile(), "n_unique", "n_missing")
    assert got == {"id": (4, 1), "a.b": (2, 4)}
    assert stats.means(["id", "a.b"]) == {"id": 1.5, "a.b": 2.0}
    assert stats.deviations(["a.b"]) == {"a.b": 0.0}


def test_only_good_rows_count(spark, tmp_path):
    stats = LoadStatistics(spark, str(tmp_path / "s"), good="ok", leave=["ok"])
    rows = part(spark, 0, 300).withColumn("ok", F.expr("id % 3 > 0"))
    Loads(spark, str(tmp_path / "s")).write(rows, good="ok")
    stats.update()
    same_as_whole(stats, rows.where("ok").drop("ok"))


def test_full_sketches_estimate(spark, tmp_path):
    stats, loads = LoadStatistics(spark, str(tmp_path / "s")), Loads(spark, str(tmp_path / "s"))
    for low in (0, 30_000):
        loads.write(spark.range(low, low + 40_000))
    stats.update()
    (row,) = stats.profile().collect()
    assert not row.exact and math.isclose(row.n_unique, 70_000, rel_tol=0.06)
    assert stats.numbers().first().n == 80_000
