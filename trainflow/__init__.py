"""Tabular classification workflows on Spark: ingest, validate, prepare, train, gate, score."""

from trainflow.spec import FeatureSpec, RunPaths

__all__ = ["FeatureSpec", "RunPaths"]
