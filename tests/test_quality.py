import pytest

from trainflow.operators import quality


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_missing_report_counts_every_column_in_one_scan(spark, jobs):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "b", "")], "id int, `a.b` string, `c d` string")
    report = quality.missing_report(df)
    assert {r["column"]: (r["total_row"], r["missing_row"]) for r in report.collect()} == {
        "id": (3, 0),
        "a.b": (3, 2),
        "c d": (3, 1),
    }
    wide = spark.range(100).selectExpr("id", *[f"id + {i} AS c{i}" for i in range(60)])
    narrow = spark.range(100).select("id")
    wide_jobs = jobs(lambda: quality.missing_report(wide).collect(), "wide")
    assert wide_jobs == jobs(lambda: quality.missing_report(narrow).collect(), "narrow")


def test_missing_report_of_an_empty_table_has_no_percentage(spark):
    report = quality.missing_report(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r["total_row"], r["missing_row"], r["missing_percentage"]) for r in report] == [(0, 0, None)] * 2
    assert quality.unwanted_columns(spark.createDataFrame([], "a int"), 20.0) == []


def test_the_limit_itself_is_not_too_much(spark):
    df = spark.createDataFrame([(i, None if i == 0 else "x", None if i < 2 else "x") for i in range(5)], "k int, at string, over string")
    assert quality.unwanted_columns(df, 20.0, always_drop=["absent"]) == ["over"]
    assert quality.unwanted_columns(df, 20.0, always_drop=["at", "k"], keep=["k"]) == ["at", "over"]


def test_split_columns_keeps_the_key_with_the_rejected_values(spark):
    df = spark.createDataFrame([(1, "a", "b")], "k int, good string, bad string")
    kept, rejected = quality.split_columns(df, ["bad", "absent", "k"], ["k"])
    assert kept.columns == ["k", "good"]
    assert rejected.first().asDict() == {"k": 1, "bad": "b", "error_msg": "Contains many missing values"}


def test_accepted_and_rejected_rows_make_up_the_table(spark):
    df = spark.createDataFrame([(1, "Yes"), (2, "N/A"), (3, None), (4, "No")], "k int, y string")
    good = quality.known_target("y", "N/A")
    assert [r.k for r in quality.accepted_rows(df, good).orderBy("k").collect()] == [1, 4]
    out = quality.rejected_rows(df, good, "unknown").orderBy("k").collect()
    assert [(r.k, r.error_msg) for r in out] == [(2, "unknown"), (3, "unknown")]
    judged = quality.with_verdict(df, good, "unknown").orderBy("k").collect()
    assert [(r.accepted, r.error_msg) for r in judged] == [(True, None), (False, "unknown"), (False, "unknown"), (True, None)]


def test_required_columns(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    quality.check_required(df, ["a", "b"])
    with pytest.raises(ValueError, match="'c'"):
        quality.check_required(df, ["a", "c"])
    assert rows(quality.required_column_report(df, ["a", "b", "c"])) == [("a", True, 1), ("b", True, 0), ("c", False, None)]
    assert rows(quality.required_column_report(df, ["c"])) == [("c", False, None)]


@pytest.mark.parametrize("exact", [True, False])
def test_column_profile_counts_null_as_a_value(spark, exact):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), (None, 2.0)], "s string, n double")
    found = {r["column"]: (r.n_unique, r.n_missing, r.missing_percentage) for r in quality.column_profile(df, exact).collect()}
    assert found == {"s": (3, 1, 25.0), "n": (3, 2, 50.0)}


def test_sketched_profile_of_an_empty_table(spark):
    row = quality.column_profile(spark.createDataFrame([], "a int"), exact=False).first()
    assert (row.n_unique, row.n_missing, row.missing_percentage) == (0, 0, None)


def test_null_counts_in_one_row(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "s string, n int")
    assert quality.null_counts(df).first().asDict() == {"s": 1, "n": 2}


def test_column_profile_tells_long_texts_apart(spark):
    long = "x" * 1000
    df = spark.createDataFrame([(long + "a",), (long + "b",), (long + "a",), ("x",)], "t string")
    assert quality.column_profile(df).first().n_unique == 3
