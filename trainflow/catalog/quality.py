"""Quality reports, quarantine and counts on the case records."""

from __future__ import annotations

from pyspark.sql import functions as F

from trainflow.catalog.tables import CASE_COLUMNS, CASE_SPEC, CASES, cases, load, per_column
from trainflow.operators import frequency, quality
from trainflow.operators.quality import known_target
from trainflow.spec import MAX_MISSING_PERCENT, UNKNOWN_TARGET_REASON
from trainflow.workspace import written

CATEGORIES = list(CASE_SPEC.categorical)
REQUIRED = [*CASE_SPEC.required_columns, "narrative"]
MODE_COLUMNS = ["priority", "segment", "channel", "sparse_note", "subject", "outcome", "case_id"]


def _known():
    return known_target(CASE_SPEC.target, CASE_SPEC.unknown_target)


def _rounded(report):
    return report.withColumn("missing_percentage", F.round("missing_percentage", 6))


def missing_report(spark, folder):
    return _rounded(quality.missing_report(cases(spark, folder)))


def high_missing_columns(spark, folder):
    report = quality.missing_report(cases(spark, folder))
    return _rounded(quality.high_missing_columns(report, MAX_MISSING_PERCENT))


def null_counts_wide(spark, folder):
    return quality.null_counts(cases(spark, folder))


def row_count(spark, folder):
    return quality.row_count(load(spark, folder, "lineitem"))


def column_profile(spark, folder):
    return _rounded(quality.column_profile(cases(spark, folder)))


def column_profile_sketch(spark, folder):
    return quality.column_profile(cases(spark, folder), exact=False)


def category_frequency(spark, folder):
    return frequency.value_counts(cases(spark, folder), CATEGORIES)


def category_cardinality(spark, folder):
    return frequency.cardinality(frequency.value_counts(cases(spark, folder), CATEGORIES))


def category_modes(spark, folder):
    return frequency.modes(cases(spark, folder), CATEGORIES)


def modes_by_candidates(spark, folder):
    """Modes of columns with few values and of some that are nearly unique."""
    return frequency.modes_by_candidates(written(cases(spark, folder), "cases"), MODE_COLUMNS)


def distinct_values(spark, folder):
    return frequency.distinct_values(cases(spark, folder), "segment")


def class_distribution(spark, folder):
    return frequency.class_distribution(cases(spark, folder), "outcome")


def event_type_distribution(spark, folder):
    return frequency.class_distribution(load(spark, folder, "events"), "event_type")


def accepted_rows(spark, folder):
    return quality.accepted_rows(cases(spark, folder), _known()).select("case_id", "priority", "outcome")


def rejected_rows(spark, folder):
    rejected = quality.rejected_rows(cases(spark, folder), _known(), UNKNOWN_TARGET_REASON)
    return rejected.select("case_id", "priority", "outcome", "error_msg")


def rows_with_verdict(spark, folder):
    judged = quality.with_verdict(cases(spark, folder), _known(), UNKNOWN_TARGET_REASON)
    return judged.select("case_id", "accepted", "error_msg")


def rejected_columns(spark, folder):
    df = written(cases(spark, folder), "cases")
    unwanted = quality.unwanted_columns(df, MAX_MISSING_PERCENT, CASE_SPEC.always_drop, CASE_SPEC.key)
    return quality.split_columns(df, unwanted, CASE_SPEC.key)[1]


def kept_columns(spark, folder):
    df = written(cases(spark, folder), "cases")
    unwanted = quality.unwanted_columns(df, MAX_MISSING_PERCENT, CASE_SPEC.always_drop, CASE_SPEC.key)
    return quality.split_columns(df, unwanted, CASE_SPEC.key)[0]


def required_column_report(spark, folder):
    return quality.required_column_report(cases(spark, folder), REQUIRED)


QUERIES = {
    "missing_report": missing_report,
    "high_missing_columns": high_missing_columns,
    "null_counts_wide": null_counts_wide,
    "row_count": row_count,
    "column_profile": column_profile,
    "column_profile_sketch": column_profile_sketch,
    "category_frequency": category_frequency,
    "category_cardinality": category_cardinality,
    "category_modes": category_modes,
    "modes_by_candidates": modes_by_candidates,
    "distinct_values": distinct_values,
    "class_distribution": class_distribution,
    "event_type_distribution": event_type_distribution,
    "accepted_rows": accepted_rows,
    "rejected_rows": rejected_rows,
    "rows_with_verdict": rows_with_verdict,
    "rejected_columns": rejected_columns,
    "kept_columns": kept_columns,
    "required_column_report": required_column_report,
}

_MISSING = per_column(
    "SELECT '{c}' AS \"column\", count(*) AS total_row, count(*) - count({c}) AS missing_row, "
    "round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS missing_percentage FROM cases",
    CASE_COLUMNS,
)
_COUNTS = per_column(
    "SELECT '{c}' AS \"column\", {c} AS value, count(*) AS cnt FROM cases GROUP BY {c}", CATEGORIES
)

ORACLES = {
    "missing_report": f"WITH {CASES} {_MISSING}",
    "high_missing_columns": f"WITH {CASES} SELECT * FROM ({_MISSING}) WHERE missing_percentage > 20",
    "null_counts_wide": f"WITH {CASES} SELECT "
    + ", ".join(f"count(*) - count({c}) AS {c}" for c in CASE_COLUMNS)
    + " FROM cases",
    "row_count": "SELECT count(*) AS total_row FROM lineitem",
    "column_profile": f"WITH {CASES} "
    + per_column(
        "SELECT '{c}' AS \"column\", count(DISTINCT {c}) + (count(*) > count({c}))::INT::BIGINT AS n_unique, "
        "count(*) - count({c}) AS n_missing, "
        "round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS missing_percentage FROM cases",
        CASE_COLUMNS,
    ),
    "category_frequency": f"WITH {CASES} {_COUNTS}",
    "category_cardinality": f'WITH {CASES} SELECT "column", count(*) AS n_category FROM ({_COUNTS}) GROUP BY 1',
    "category_modes": f"""WITH {CASES} SELECT "column", value, cnt FROM (
        SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS place
        FROM ({_COUNTS}) WHERE value IS NOT NULL) WHERE place = 1""",
    "modes_by_candidates": f"""WITH {CASES} SELECT "column", value, cnt FROM (
        SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS place FROM ("""
    + per_column(
        "SELECT '{c}' AS \"column\", {c}::VARCHAR AS value, count(*) AS cnt FROM cases WHERE {c} IS NOT NULL GROUP BY {c}",
        MODE_COLUMNS,
    )
    + ")) WHERE place = 1",
    "distinct_values": f"WITH {CASES} SELECT DISTINCT segment FROM cases",
    "class_distribution": f"WITH {CASES} SELECT outcome, count(*) AS cnt FROM cases GROUP BY 1 ORDER BY 2 DESC, 1",
    "event_type_distribution": "SELECT event_type, count(*) AS cnt FROM events GROUP BY 1 ORDER BY 2 DESC, 1",
    "accepted_rows": f"WITH {CASES} SELECT case_id, priority, outcome FROM cases WHERE outcome <> 'N/A'",
    "rejected_rows": f"""WITH {CASES} SELECT case_id, priority, outcome,
        'Dropped row as target label is unknown' AS error_msg
        FROM cases WHERE outcome = 'N/A' OR outcome IS NULL""",
    "rows_with_verdict": f"""WITH {CASES} SELECT case_id, outcome <> 'N/A' AS accepted,
        CASE WHEN outcome = 'N/A' THEN 'Dropped row as target label is unknown' END AS error_msg FROM cases""",
    "rejected_columns": f"""WITH {CASES} SELECT case_id, sparse_note,
        'Contains many missing values' AS error_msg FROM cases""",
    "kept_columns": f"WITH {CASES} SELECT * EXCLUDE (sparse_note) FROM cases",
    "required_column_report": f"WITH {CASES} "
    + per_column("SELECT '{c}' AS \"column\", true AS present, count({c}) AS filled_row FROM cases", REQUIRED[:-1])
    + " UNION ALL SELECT 'narrative', false, NULL",
}
