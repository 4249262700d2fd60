"""JSON landing files: scan, envelope, quarantine, compaction to Parquet."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainflow.operators.quality import ERROR_COLUMN
from trainflow.sources.arrays import read_payloads
from trainflow.sources.ledger import Load, Loads

CORRUPT = "_corrupt_record"
PAYLOAD_OK = "payload_ok"
LOAD = "load"
ENVELOPE = "_source"
BAD_PAYLOAD = "Payload is not valid JSON"
UNFIT_PAYLOAD = "Payload does not fit the record"
#: Columns that a store adds to the record's.
RESERVED = (LOAD, PAYLOAD_OK, CORRUPT, ERROR_COLUMN)


def refuse_names(columns: Iterable[str], reserved: Iterable[str]) -> None:
    """Raise if a table has columns that a step would write over."""
    clash = sorted({c.lower() for c in columns} & {c.lower() for c in reserved})
    if clash:
        raise ValueError(f"columns {', '.join(clash)} have names that are added here; rename them first")


def payload_schema(record: T.StructType) -> T.StructType:
    """Read schema of records with a place for the text of those that do not parse."""
    return T.StructType([*record.fields, T.StructField(CORRUPT, T.StringType())])


def parse_json(df: DataFrame, text: str, record: T.StructType, output: str = "record") -> DataFrame:
    """JSON objects held in a column: adds a struct with the fields and ``_corrupt_record``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.withColumn(output, F.from_json(text, payload_schema(record), options))


def parsed(corrupt: Column | None = None) -> Column:
    return (F.col(CORRUPT) if corrupt is None else corrupt).isNull()


def scan_lines(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Landing files element by element: the text as ``payload`` and what it parses to as ``record``."""
    return parse_json(read_payloads(spark, path), "payload", record)


def _reason() -> Column:
    return F.when(F.try_parse_json("payload").isNull(), BAD_PAYLOAD).otherwise(UNFIT_PAYLOAD)


def bad_lines(lines: DataFrame) -> DataFrame:
    """Scanned elements that do not parse or fit, with a reason."""
    return lines.where(~parsed(F.col("record")[CORRUPT])).select("payload", _reason().alias(ERROR_COLUMN))


def _flat(payloads: DataFrame, record: T.StructType) -> DataFrame:
    """The record's fields, and the text and the reason of payloads that do not parse."""
    df = parse_json(payloads, "payload", record)
    corrupt = F.col("record")[CORRUPT]
    fields = [F.when(parsed(corrupt), F.col("record")[f.name]).alias(f.name) for f in record.fields]
    return df.select(*fields, corrupt.alias(CORRUPT), F.when(~parsed(corrupt), _reason()).alias(ERROR_COLUMN))


def scan_json(spark: SparkSession, path: str, record: T.StructType | None = None) -> DataFrame:
    """All JSON files below a path in one scan.

    With a declared schema nothing is inferred, and each object is judged alone: text that does not
    parse or fit is kept in ``_corrupt_record`` with its reason, whatever columns are read.
    """
    if record is None:
        return spark.read.json(path)
    return _flat(read_payloads(spark, path), record)


def unwrap(df: DataFrame, envelope: str = ENVELOPE) -> DataFrame:
    """Payloads of the elements that have an envelope; the others are left out."""
    return df.where(F.col(envelope).isNotNull()).select(f"{envelope}.*")


def good_payloads(df: DataFrame) -> DataFrame:
    return df.where(parsed()).drop(CORRUPT, ERROR_COLUMN)


def bad_payloads(df: DataFrame) -> DataFrame:
    """Texts that did not parse or fit, with the reason."""
    return df.where(~parsed()).select(F.col(CORRUPT).alias("payload"), ERROR_COLUMN)


def stored(
    payloads: DataFrame,
    record: T.StructType,
    store: str,
    load: str | None = None,
    enveloped: bool = False,
    **source,
) -> Load:
    """Write JSON payloads to a store, as one load.

    A load with a name replaces what an earlier attempt of it left, also if it now has no rows.
    ``enveloped`` elements hold the record in ``_source``; those without it are left out. ``source`` is
    what the store's ledger keeps of a stream's batch: ``stream``, ``batch`` and ``taken``.
    """
    refuse_names(record.fieldNames(), RESERVED)
    if enveloped:
        envelope = T.StructType([T.StructField(ENVELOPE, record)])
        flat = _flat(payloads, envelope).where(F.col(ENVELOPE).isNotNull() | ~parsed())
        flat = flat.select(*[F.col(ENVELOPE)[f.name].alias(f.name) for f in record.fields], CORRUPT, ERROR_COLUMN)
    else:
        flat = _flat(payloads, record)
    return Loads(payloads.sparkSession, store).write(flat.withColumn(PAYLOAD_OK, parsed()), PAYLOAD_OK, load, **source)


def compact(spark: SparkSession, landing: str, record: T.StructType, store: str, load: str | None = None) -> None:
    """Add all landing files to a Parquet store: one scan, one write, no file counted first.

    An absent or empty landing folder adds nothing.
    """
    stored(read_payloads(spark, landing), record, store, load)


def compact_enveloped(
    spark: SparkSession, landing: str, record: T.StructType, store: str, load: str | None = None
) -> None:
    """Like :func:`compact` for ``{"_source": {..}}`` elements; elements without it are left out."""
    stored(read_payloads(spark, landing), record, store, load, enveloped=True)


def read_store(spark: SparkSession, store: str, record: T.StructType | None = None) -> DataFrame:
    """Good records of a store's loads; files of earlier loads may lack columns added since.

    With the declared record no file is opened to learn the columns, and a store not yet written is empty.
    """
    if record is None:
        return _rows(spark, store).where(PAYLOAD_OK).drop(*RESERVED)
    schema = T.StructType([*record.fields, T.StructField(PAYLOAD_OK, T.BooleanType())])
    rows = Loads(spark, store).read(schema)
    if rows is None:
        return spark.createDataFrame([], record)
    return rows.where(PAYLOAD_OK).select(*record.fieldNames())


def _rows(spark: SparkSession, store: str) -> DataFrame:
    rows = Loads(spark, store).read()
    if rows is None:
        raise LookupError(f"nothing was loaded into {store}")
    return rows


def read_quarantine(spark: SparkSession, store: str) -> DataFrame:
    """Payloads of a store that did not parse or fit, with the reason."""
    return bad_payloads(_rows(spark, store))
