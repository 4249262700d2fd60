"""Which loads make up a store: a log of loads that readers follow.

Each attempt of a load writes a folder of its own, ``load=<name>/attempt=<id>``, and is entered in the
log ``_loads`` of the store once it is complete. The newest entry of a name counts. So a repeated load
replaces what it left, also with no rows at all; an attempt that broke off is never read; and readers
see a load whole or not at all. Loads of streams keep a table of the files they took, below ``_taken``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainflow.sources.files import NumberedLog, delete, names
from trainflow.sources.tables import read_table

TAKEN = "path string, length long, modified timestamp"


@dataclass(frozen=True)
class Load:
    """An entry: the load's name, the folder of its rows below the store, how many there are and how
    many of them are good, the stream and batch it belongs to, and the number of files taken."""

    name: str
    folder: str
    rows: int
    good: int
    stream: str | None = None
    batch: int | None = None
    files: int | None = None


class Loads:
    """The loads of one store."""

    def __init__(self, spark: SparkSession, store: str):
        self.spark = spark
        self.store = store.rstrip("/")
        self.log = NumberedLog(spark, f"{self.store}/_loads")

    def current(self) -> dict[str, Load]:
        """The newest entry of each load, in the order they were first entered."""
        fields = Load.__dataclass_fields__
        return {e["name"]: Load(**{k: v for k, v in e.items() if k in fields}) for e in self.log.entries()}

    def write(self, rows: DataFrame, good: str | None = None, name: str | None = None, stream: str | None = None, batch: int | None = None,
              taken: DataFrame | None = None) -> Load:
        """Writes the rows as an attempt of a load and enters it; ``good`` is the column that marks good rows,
        without which all are.

        ``taken`` are the files of a stream's batch: ``path, length, modified``.
        """
        name = name or uuid.uuid4().hex
        attempt = uuid.uuid4().hex
        folder = f"load={quote(name, safe='')}/attempt={attempt}"
        rows.write.parquet(f"{self.store}/{folder}")
        found = self.spark.read.schema(rows.schema).parquet(f"{self.store}/{folder}")
        counts = found.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(good) if good else F.lit(True)).alias("good")).first()
        files = None
        if taken is not None:
            taken.coalesce(1).write.parquet(f"{self.store}/_taken/{attempt}")
            files = self.spark.read.schema(TAKEN).parquet(f"{self.store}/_taken/{attempt}").count()
        load = Load(name, folder, counts["rows"], counts["good"], stream, batch, files)
        self.log.append(asdict(load))
        return load

    def read(self, schema=None) -> DataFrame | None:
        """The rows of all loads; None before the first load. Without a schema columns are put together by name."""
        loads = list(self.current().values())
        if not loads:
            return None
        # A load without rows still has its columns, in a file of its own.
        folders = [f"{self.store}/{x.folder}" for x in loads if x.rows] or [f"{self.store}/{x.folder}" for x in loads]
        if schema is not None:
            return self.spark.read.schema(schema).parquet(*folders)
        return read_table(self.spark, *folders, merge=True)

    def taken(self, but: str) -> DataFrame:
        """Files that loads of streams other than the one named took."""
        folders = [x.folder.rpartition("=")[2] for x in self.current().values() if x.stream not in (None, but) and x.files]
        paths = [f"{self.store}/_taken/{f}" for f in folders]
        return self.spark.read.schema(TAKEN).parquet(*paths) if paths else self.spark.createDataFrame([], TAKEN)

    def report(self) -> DataFrame:
        """``name, rows, good, stream, batch, files`` of every load."""
        rows = [(x.name, x.rows, x.good, x.stream, x.batch, x.files) for x in self.current().values()]
        return self.spark.createDataFrame(rows, "name string, rows long, good long, stream string, batch long, files long")

    def forget(self, keep: Sequence[str] = ()) -> list[str]:
        """Deletes attempts that were replaced, and returns their folders. Attempts that are not entered,
        as somebody may be writing them, stay; so do those of loads named in ``keep``."""
        entered = [Load(**{k: v for k, v in e.items() if k != "number"}) for e in self.log.entries()]
        now = {x.folder for x in self.current().values()}
        gone = []
        for x in entered:
            parent, _, attempt = x.folder.rpartition("/")
            if x.folder not in now and x.name not in keep and attempt in names(self.spark, f"{self.store}/{parent}"):
                delete(self.spark, f"{self.store}/{x.folder}")
                delete(self.spark, f"{self.store}/_taken/{attempt.rpartition('=')[2]}")
                gone.append(x.folder)
        return gone
