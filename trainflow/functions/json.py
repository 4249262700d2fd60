"""Rows as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_as_json(*columns: str) -> Column:
    """One JSON object holding the named columns; null fields are left out."""
    return F.to_json(F.struct(*columns))
