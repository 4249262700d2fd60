"""Column expressions. All of them run inside the JVM."""

from trainflow.functions.dates import elapsed_days, next_period_end, previous_period_end, to_timestamp
from trainflow.functions.hashing import hash_bucket, percent_bucket
from trainflow.functions.json import row_as_json
from trainflow.functions.numbers import largest_number, missing_percentage, path_version
from trainflow.functions.text import tokens

__all__ = [
    "elapsed_days",
    "hash_bucket",
    "largest_number",
    "missing_percentage",
    "next_period_end",
    "path_version",
    "percent_bucket",
    "previous_period_end",
    "row_as_json",
    "to_timestamp",
    "tokens",
]
