"""Dates: elapsed days, and the ends of weeks, months and years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_IN_DAY = 86_400


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_timestamp(c: Column | str) -> Column:
    """Timestamp in the session time zone; a malformed string becomes null."""
    return _column(c).try_cast("timestamp")


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Absolute difference of two moments in days, fractions kept, counted in whole seconds."""
    seconds = F.abs(to_timestamp(end).cast("long") - to_timestamp(start).cast("long"))
    return seconds / F.lit(float(SECONDS_IN_DAY))


def previous_period_end(day: Column | str, unit: str) -> Column:
    """Last day on or before ``day`` that ends a period. Weeks end on Sunday.

    ``unit`` is ``week``, ``month`` or ``year``.
    """
    return F.date_sub(F.trunc(F.date_add(_column(day), 1), unit), 1)


def next_period_end(day: Column | str, unit: str) -> Column:
    """First day after ``day`` that ends a period."""
    first_of_period = F.trunc(F.date_add(_column(day), 1), unit)
    if unit == "week":
        return F.date_add(first_of_period, 6)
    months = {"month": 1, "year": 12}[unit]
    return F.date_sub(F.add_months(first_of_period, months), 1)
