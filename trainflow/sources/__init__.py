"""Scans, sinks, state tables and the model registry."""
