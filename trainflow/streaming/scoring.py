"""Scoring new rows as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trainflow.plans.scoring import score_into
from trainflow.spec import FeatureSpec
from trainflow.streaming.ingest import stream_identity


def stream_score(
    model: PipelineModel,
    stream: DataFrame,
    spec: FeatureSpec,
    output: str,
    checkpoint: str,
    extra: Sequence[str] = (),
) -> StreamingQuery:
    """Add predictions for the rows of a stream not scored before to a store of them, then stop.

    Each batch is scored as a table of its own, so every stage may do what it does for tables: counts
    beyond the broadcast limit are joined by a shuffle that parts hot values. A batch is a load named by
    the stream and its number, so a repeated batch replaces itself; ``read_scores`` gives each row once.
    """

    def add(rows: DataFrame, batch: int) -> None:
        identity = stream_identity(rows.sparkSession, checkpoint)
        score_into(model, rows, spec, output, f"stream-{identity}-{batch}", extra, stream=identity, batch=batch)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
