"""Incremental forms of ingest and scoring; the checkpoint is the watermark."""

from trainflow.streaming.ingest import stream_ingest
from trainflow.streaming.scoring import stream_score

__all__ = ["stream_ingest", "stream_score"]
