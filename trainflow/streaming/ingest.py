"""Landing files as a stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trainflow.sources.arrays import read_payloads
from trainflow.sources.files import literal, read_text
from trainflow.sources.landing import RESERVED, refuse_names, stored
from trainflow.sources.ledger import Loads


#: The columns of files that Spark lists.
LISTED = "path string, modificationTime timestamp, length long, content binary"


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when it began its checkpoint; a new checkpoint is a new stream."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def stream_ingest(
    spark: SparkSession,
    landing: str,
    record: T.StructType,
    store: str,
    checkpoint: str,
    files_per_batch: int = 1_000,
    enveloped: bool = False,
) -> StreamingQuery:
    """Add landing files not seen before to a store, then stop.

    The stream is one of files; each batch reads its own as a batch job does, however long their lines.
    Every file is taken once over all runs with one checkpoint: a batch is a load named by the stream and
    its number, so a repeated batch replaces itself. A stream whose checkpoint was lost begins anew: the
    store's ledger tells it which files, by path, length and time, earlier streams have taken. Batch
    jobs may write to the same store.
    """
    refuse_names(record.fieldNames(), RESERVED)

    def add(listed: DataFrame, batch: int) -> None:
        own, stream = listed.sparkSession, stream_identity(spark, checkpoint)
        found = listed.select("path", "length", F.col("modificationTime").alias("modified"))
        rows = found.join(Loads(own, store).taken(but=stream), found.columns, "left_anti").collect()
        taken = own.createDataFrame(rows, found.schema)
        payloads = read_payloads(own, [literal(r["path"]) for r in rows])
        stored(payloads, record, store, f"stream-{stream}-{batch}", enveloped, stream=stream, batch=batch, taken=taken)

    # Contents are not read here: only columns of the listing are selected.
    arriving = spark.readStream.format("binaryFile").schema(LISTED).option("maxFilesPerTrigger", files_per_batch).load(landing)
    listed = arriving.select("path", "length", "modificationTime")
    writer = listed.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
