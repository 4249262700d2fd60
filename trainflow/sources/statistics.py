"""Statistics of a store kept load by load: a new load is scanned once, earlier ones never again.

A state of a load has one row per column: rows, nulls, count, mean and sum of squared deviations of a numeric
column, and a sketch of the distinct values. States are put together without reading rows: counts add up, means
and deviations by the pairwise formula for variances, sketches by their union. A state belongs to an
attempt of a load, so a repeated load brings its own, and one that was replaced counts no more.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainflow.functions import missing_percentage
from trainflow.operators.quality import quoted
from trainflow.sources.files import NumberedLog, full, literal
from trainflow.sources.ledger import Load, Loads

#: A sketch holds up to 2^SKETCH values, so fewer distinct ones are counted exactly; beyond, the
#: standard error is 2^(-SKETCH / 2), 1.6 per cent.
SKETCH = 12
STATE = "column string, total_row long, missing_row long, n long, mean double, m2 double, sketch binary"


def column_states(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column, with the columns of ``STATE``, from one scan whose tasks each send one row.

    NaN is a value, but no number: it counts for neither mean nor deviation. A column that is not
    numeric has ``n`` 0. Nulls are not in the sketch. Values are told apart by their text, as in
    :func:`trainflow.operators.quality.column_profile`. An empty table has rows with zeros.
    """
    names = list(columns) if columns is not None else df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    entries = []
    for i, c in enumerate(names):
        numeric = isinstance(kinds[c], T.NumericType)
        number = F.nanvl(quoted(c).cast("double"), F.lit(None)) if numeric else F.lit(None).cast("double")
        sketch = F.theta_sketch_agg(quoted(c).cast("string"), F.lit(SKETCH))
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(F.lit(1)).alias("total_row"),
                F.count_if(quoted(c).isNull()).alias("missing_row"),
                F.count(number).alias("n"),
                F.avg(number).alias("mean"),
                (F.var_pop(number) * F.count(number)).alias("m2"),
                sketch.alias("sketch"),
            ).alias(f"entry_{i}")
        )
    if not entries:
        return df.sparkSession.createDataFrame([], STATE)
    counted = df.agg(*entries)
    return counted.select(F.inline(F.array(*[F.col(f"entry_{i}") for i in range(len(names))])))


def merged(states: DataFrame, total: Column) -> DataFrame:
    """The state of all rows from states of disjoint parts of them; ``total`` is the number of all rows.

    A column that a part does not have is null in all its rows.
    """
    means = states.groupBy("column").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("whole_mean")
    )
    off = F.col("mean") - F.col("whole_mean")
    whole = states.join(means, "column").groupBy("column").agg(
        F.sum("total_row").alias("present"),
        F.sum("missing_row").alias("missing"),
        F.sum("n").alias("n"),
        F.first("whole_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"),
        F.theta_union_agg("sketch", F.lit(SKETCH)).alias("sketch"),
    )
    return whole.select(
        "column",
        total.cast("long").alias("total_row"),
        (total - F.col("present") + F.col("missing")).cast("long").alias("missing_row"),
        "n",
        "mean",
        "m2",
        "sketch",
    )


class LoadStatistics:
    """Statistics over the loads of one store, kept in ``<store>/_states``.

    ``good`` is the column that marks the rows that count, all without one; ``leave`` names columns that
    have no statistics. Both have to be the same in all uses of one store.
    """

    def __init__(self, spark: SparkSession, store: str, good: str | None = None, leave: Sequence[str] = ()):
        self.spark = spark
        self.loads = Loads(spark, store)
        self.good = good
        self.leave = set(leave)
        self.folder = f"{self.loads.store}/_states"
        self.log = NumberedLog(spark, f"{self.folder}/_log")

    def _known(self) -> dict[str, dict]:
        return {e["load"]: e for e in self.log.entries()}

    def missing(self) -> list[Load]:
        """Loads that have no state yet."""
        known = self._known()
        return [x for x in self.loads.current().values() if x.folder not in known]

    def update(self) -> list[Load]:
        """Scans the loads that have no state yet, each once, and returns them.

        A run that breaks off has the states entered so far. Two runs at a time enter equal states;
        the later one counts.
        """
        fresh = self.missing()
        for load in fresh:
            rows = self.spark.read.parquet(literal(full(self.spark, f"{self.loads.store}/{load.folder}")))
            rows = rows.where(quoted(self.good)) if self.good else rows
            path = f"{self.folder}/{uuid.uuid4().hex}"
            states = column_states(rows, [c for c in rows.columns if c not in self.leave])
            states.coalesce(1).write.parquet(path)
            self.log.append({"load": load.folder, "state": path.rpartition("/")[2], "rows": load.good if self.good else load.rows})
        return fresh

    def states(self) -> DataFrame:
        """One row per column over the loads that count now. Raises LookupError if one has no state yet."""
        known, current = self._known(), self.loads.current().values()
        absent = [x.name for x in current if x.folder not in known]
        if absent:
            raise LookupError(f"loads without statistics: {absent}; call update()")
        entries = [known[x.folder] for x in current]
        if not entries:
            return self.spark.createDataFrame([], STATE)
        paths = [literal(full(self.spark, f"{self.folder}/{e['state']}")) for e in entries]
        return merged(self.spark.read.schema(STATE).parquet(*paths), F.lit(sum(e["rows"] for e in entries)))

    def missing_report(self) -> DataFrame:
        """As :func:`trainflow.operators.quality.missing_report` over the rows of all loads."""
        percentage = missing_percentage(F.col("missing_row"), F.col("total_row")).alias("missing_percentage")
        return self.states().select("column", "total_row", "missing_row", percentage)

    def profile(self) -> DataFrame:
        """As :func:`trainflow.operators.quality.column_profile`: null is a value. ``exact`` tells whether
        ``n_unique`` was counted or estimated from a sketch that is full."""
        distinct = F.theta_sketch_estimate("sketch")
        return self.states().select(
            "column",
            (distinct + (F.col("missing_row") > 0).cast("long")).alias("n_unique"),
            F.col("missing_row").alias("n_missing"),
            missing_percentage(F.col("missing_row"), F.col("total_row")).alias("missing_percentage"),
            (distinct < (1 << SKETCH) * 7 // 8).alias("exact"),
        )

    def numbers(self) -> DataFrame:
        """``column, n, mean, deviation`` of columns with numbers; the sample deviation is 0 for one number."""
        deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).otherwise(F.lit(0.0))
        return self.states().where("n > 0").select("column", "n", "mean", deviation.alias("deviation"))

    def means(self, columns: Sequence[str]) -> dict[str, float | None]:
        """As :func:`trainflow.operators.frequency.means`, for its ``fill_means``."""
        # One row per column of the table, whatever the number of rows.
        found = {r["column"]: r["mean"] for r in self.numbers().collect()}
        return {c: found.get(c) for c in columns}

    def deviations(self, columns: Sequence[str]) -> dict[str, float]:
        """As :func:`trainflow.operators.scaling.deviations`, for its ``scale``."""
        found = {r["column"]: r["deviation"] for r in self.numbers().collect()}
        return {c: found.get(c, 0.0) for c in columns}
