"""Text to words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column | str) -> Column:
    """Lower-case words of a text, split on white space, empty words left out; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s")
    return F.array_remove(words, "")
