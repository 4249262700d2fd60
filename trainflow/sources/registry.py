"""Versioned models: saved pipelines and a log that lists them."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainflow.operators.history import newest
from trainflow.sources.files import Conflict, NumberedLog

COLUMNS = "model_key string, version long, path string, f1 double, created_ts timestamp"


class ModelRegistry:
    """Saved models, listed in a log with one entry per version.

    A model is saved before it is listed, so a listed model is always complete. A version is listed once:
    of two runs that ask for one number at a time the second is refused, and runs that leave the number
    to the registry get different ones.
    """

    def __init__(self, spark: SparkSession, table: str, models: str):
        self.spark = spark
        self.log = NumberedLog(spark, table)
        self.models = models.rstrip("/")
        self._loaded: tuple[str, PipelineModel] | None = None

    def register(self, model: PipelineModel, key: str, f1: float | None = None, version: int | None = None) -> str:
        """Save a model as a new version under ``<models>/<key>/saved_models/`` and return its path.

        Without a version the folder is named by the time, and the number listed may be a later one.
        """
        path = f"{self.models}/{key}/saved_models/{time.time_ns() // 1_000_000 if version is None else version}/model"
        saved = model.write()
        (saved if version is None else saved.overwrite()).save(path)
        self.list_saved(path, key, f1, version)
        return path

    def list_saved(self, path: str, key: str, f1: float | None = None, version: int | None = None) -> int:
        """Make a model saved elsewhere, such as in a run's folder, a new version without copying it.

        Returns its number: the one given, which must be new, or the time in milliseconds, or one more
        than the largest if that is later.
        """
        while True:
            entries = self.log.entries()
            held = {e["version"] for e in entries if e["model_key"] == key}
            if version in held:
                raise Conflict(f"version {version} of {key} is listed already")
            number = max([time.time_ns() // 1_000_000, *(v + 1 for v in held)]) if version is None else version
            created = datetime.now(timezone.utc).isoformat()
            entry = {"model_key": key, "version": number, "path": path, "f1": f1, "created_ts": created}
            try:
                self.log.append(entry, after=entries[-1]["number"] if entries else 0)
                return number
            except Conflict:
                continue  # somebody listed a model meanwhile; look again

    def all_versions(self) -> DataFrame:
        rows = [
            (e["model_key"], e["version"], e["path"], e["f1"], datetime.fromisoformat(e["created_ts"])) for e in self.log.entries()
        ]
        return self.spark.createDataFrame(rows, COLUMNS)

    def versions(self, key: str) -> DataFrame:
        return self.all_versions().where(F.col("model_key") == key)

    def newest_versions(self) -> DataFrame:
        """Newest version of every key, by number."""
        return newest(self.all_versions(), ["model_key"], ["version", "created_ts", "path"])

    def newest_path(self, key: str) -> str | None:
        row = newest(self.versions(key), ["model_key"], ["version", "created_ts", "path"]).select("path").first()
        return row["path"] if row else None

    def available(self, key: str) -> bool:
        return not self.versions(key).isEmpty()

    def load_newest(self, key: str) -> PipelineModel:
        """Newest model of a key; read again only when there is a newer one."""
        path = self.newest_path(key)
        if path is None:
            raise LookupError(f"no model registered for {key}")
        if self._loaded is None or self._loaded[0] != path:
            self._loaded = (path, PipelineModel.load(path))
        return self._loaded[1]
