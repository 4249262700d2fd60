"""Registered queries beside their SQL on the smallest test tables."""

import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_queries import compare, type_problem  # noqa: E402

from __spark_entry__ import SMALLEST, entry, oracle_sql, queries  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(SMALLEST).exists(), reason="test tables not present")

# Whole training runs are tested on small frames in test_workflow.py, test_resume.py and test_inputs.py.
LONG = {"retrain_gate", "batch_score_archive", "batch_score_types", "batch_score_absent_input", "resumed_run"}
LONG |= {"scores_in_one_store", "stream_score_wide_frequency"}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in Path(SMALLEST).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - LONG))
def test_query_equals_its_sql(spark, sql, name):
    df = queries()[name](spark, SMALLEST)
    cursor = sql.execute(oracle_sql()[name])
    assert not type_problem(df, cursor)
    columns = [d[0] for d in cursor.description]
    assert not compare(df.collect(), df.columns, cursor.fetchall(), columns)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_scores_every_case(spark):
    df = entry(spark)
    assert "prediction_outcome" in df.columns
    assert df.count() == spark.read.parquet(f"{SMALLEST}/orders.parquet").count()
