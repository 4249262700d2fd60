"""Runs every operator on the test tables, with the same question in plain SQL beside it."""

from trainflow.catalog import encode, ingest, model, prepare, quality, store

MODULES = (quality, ingest, store, prepare, encode, model)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
