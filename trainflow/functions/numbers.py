"""Small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing_percentage(missing: Column, total: Column) -> Column:
    """``missing`` as a percentage of ``total``; null where there are no rows."""
    return F.try_divide(missing * F.lit(100.0), total.cast("double"))


def largest_number(text: Column | str) -> Column:
    """Largest run of digits in a text, as a number; null if there is none.

    Runs too long for a long are skipped.
    """
    digits = F.regexp_extract_all(text, F.lit(r"(\d+)"), 1)
    return F.array_max(F.transform(digits, lambda d: d.try_cast("long")))


def path_version(path: Column | str) -> Column:
    """Version number of a model path ``<key>/saved_models/<version>/...``."""
    return F.regexp_extract(path, r"/saved_models/(\d+)(?:/|$)", 1).try_cast("long")
