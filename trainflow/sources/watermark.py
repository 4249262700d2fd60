"""Where the last load ended: a log with one entry per run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from trainflow.sources.files import NumberedLog

COLUMNS = "from_date date, to_date date, data_file_path string, recorded_at timestamp"

# Fixed value: no load starts before this day.
EARLIEST = date(2023, 7, 10)


@dataclass(frozen=True)
class LoadSpan:
    """Half-open span ``start <= day < end`` of the next load, and the last entry that it was planned after."""

    start: date
    end: date
    after: int | None = field(default=None, compare=False)

    @property
    def empty(self) -> bool:
        return self.start >= self.end


def record_load(spark: SparkSession, path: str, span: LoadSpan, data_path: str) -> None:
    """Remember a finished load. Raises :class:`Conflict` if another run recorded one since the span was planned."""
    entry = {"from_date": str(span.start), "to_date": str(span.end), "data_file_path": data_path}
    NumberedLog(spark, path).append(entry | {"recorded_at": datetime.now(timezone.utc).isoformat()}, span.after)


def _ends(log: NumberedLog) -> tuple[date | None, int]:
    entries = log.entries()
    return max((date.fromisoformat(e["to_date"]) for e in entries), default=None), entries[-1]["number"] if entries else 0


def loads(spark: SparkSession, path: str) -> DataFrame | None:
    """All recorded loads, or None before the first."""
    entries = NumberedLog(spark, path).entries()
    days = ("from_date", "to_date")
    rows = [(*(date.fromisoformat(e[d]) for d in days), e["data_file_path"], datetime.fromisoformat(e["recorded_at"])) for e in entries]
    return spark.createDataFrame(rows, COLUMNS) if rows else None


def last_end(spark: SparkSession, path: str) -> date | None:
    return _ends(NumberedLog(spark, path))[0]


def next_span(
    spark: SparkSession,
    path: str,
    start: date | None = None,
    end: date | None = None,
    earliest: date = EARLIEST,
) -> LoadSpan:
    """Span of the next load: from the last end if there is one, else from ``start``, at the earliest
    ``earliest``; up to ``end``, today by default. An empty span means nothing to do."""
    ended, number = _ends(NumberedLog(spark, path))
    return LoadSpan(ended or max(start or earliest, earliest), end or date.today(), number)
