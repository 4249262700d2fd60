"""Pipeline stages Spark ML does not have: elapsed days, mode imputation, frequency encoding, wide indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLWritable,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from trainflow.functions import elapsed_days, to_timestamp
from trainflow.operators.frequency import category_index, mode_values, value_counts
from trainflow.operators.lookup import TableSize, lookup
from trainflow.operators.quality import quoted
from trainflow.workspace import new_folder


class _Columns(HasInputCols, HasOutputCols):
    """Input and output column lists with setters."""

    def setInputCols(self, value: Sequence[str]):
        return self._set(inputCols=list(value))

    def setOutputCols(self, value: Sequence[str]):
        return self._set(outputCols=list(value))


class ElapsedDays(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Days between pairs of moments: inputs ``[start, end, start, end, ..]``, one output per pair.

    The inputs themselves become timestamps; malformed strings become null.
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        return self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs = self.getInputCols()
        moments = dataset.withColumns({c: to_timestamp(quoted(c)) for c in dict.fromkeys(inputs)})
        pairs = zip(inputs[::2], inputs[1::2], self.getOutputCols())
        return moments.withColumns({out: elapsed_days(quoted(a), quoted(b)) for a, b, out in pairs})


class ConstantFiller(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Copy columns with their nulls replaced by a fixed value per column."""

    values = Param(Params._dummy(), "values", "one value per column", typeConverter=TypeConverters.toList)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        values: Sequence | None = None,
    ):
        super().__init__()
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        values: Sequence | None = None,
    ):
        return self._set(**self._input_kwargs)

    def getValues(self) -> list:
        return self.getOrDefault(self.values)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = zip(self.getInputCols(), self.getOutputCols(), self.getValues())
        return dataset.withColumns({out: F.coalesce(quoted(c), F.lit(v)) for c, out, v in columns})


class _Modes(_Columns):
    modes = Param(Params._dummy(), "modes", "most frequent value of each input column, or null")

    def getModes(self) -> list[str | None]:
        return self.getOrDefault(self.modes)

    def setModes(self, value: Sequence[str | None]):
        return self._set(modes=list(value))


class ModeImputer(Estimator, _Modes, DefaultParamsReadable, DefaultParamsWritable):
    """Learn the most frequent non-null value of several columns in one job; ties go to the smaller."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        return self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ModeImputerModel":
        learnt = mode_values(dataset, self.getInputCols())
        model = ModeImputerModel(inputCols=self.getInputCols(), outputCols=self.getOutputCols())
        return model.setModes([learnt[c] for c in self.getInputCols()])


class ModeImputerModel(Model, _Modes, DefaultParamsReadable, DefaultParamsWritable):
    """Copy columns as text with nulls replaced by the learnt value; a column without one keeps its nulls."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = zip(self.getInputCols(), self.getOutputCols(), self.getModes())
        return dataset.withColumns({out: F.coalesce(quoted(c).cast("string"), F.lit(v)) for c, out, v in columns})


class _Frequencies(_Columns):
    how = Param(
        Params._dummy(),
        "how",
        "left: keep all rows, 0 for null and unseen values; inner: drop those rows",
        typeConverter=TypeConverters.toString,
    )

    def __init__(self):
        super().__init__()
        self._setDefault(how="left")

    def getHow(self) -> str:
        return self.getOrDefault(self.how)

    def setHow(self, value: str):
        return self._set(how=value)


class FrequencyEncoder(Estimator, _Frequencies, DefaultParamsReadable, DefaultParamsWritable):
    """Learn how often each value of several columns occurs, as a table in the shared folder."""

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        how: str | None = None,
    ):
        super().__init__()
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        how: str | None = None,
    ):
        return self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FrequencyEncoderModel":
        return self.fit_counts(value_counts(dataset, self.getInputCols()))

    def fit_counts(self, counts: DataFrame) -> "FrequencyEncoderModel":
        """Learn from value counts, ``column, value, cnt``, made before; other columns' are left out."""
        columns, spark = self.getInputCols(), counts.sparkSession
        path = new_folder(spark, "frequencies")
        own = counts.where(F.col("value").isNotNull() & F.col("column").isin(columns))
        own.write.partitionBy("column").parquet(path)
        model = FrequencyEncoderModel(inputCols=columns, outputCols=self.getOutputCols(), how=self.getHow())
        model.setTablePath(path)
        width = F.octet_length("value") + F.octet_length(F.col("cnt").cast("string"))
        measured = model.tables(spark).groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b"))
        sizes = {r["column"]: [r["n"], r["b"]] for r in measured.collect()}
        return model.setSizes([sizes.get(c, [0, 0]) for c in columns])


class FrequencyEncoderModel(Model, _Frequencies, MLReadable, MLWritable):
    """Add the learnt count of each value as a double."""

    tablePath = Param(Params._dummy(), "tablePath", "folder of the counts", typeConverter=TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "rows and bytes of each column's counts")

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        how: str | None = None,
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def setTablePath(self, value: str):
        return self._set(tablePath=value)

    def getTablePath(self) -> str:
        return self.getOrDefault(self.tablePath)

    def setSizes(self, value: Sequence[Sequence[int]]):
        return self._set(sizes=[list(s) for s in value])

    def getSizes(self) -> list[list[int]]:
        return self.getOrDefault(self.sizes)

    def tables(self, spark) -> DataFrame:
        """The learnt counts, ``column, value, cnt``."""
        return spark.read.schema("value string, cnt long, column string").parquet(self.getTablePath())

    def table(self, spark, column: str) -> DataFrame:
        return self.tables(spark).where(F.col("column") == column).select("value", "cnt")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        result = dataset
        for c, out, size in zip(self.getInputCols(), self.getOutputCols(), self.getSizes()):
            table = self.table(dataset.sparkSession, c)
            key = quoted(c).cast("string")
            joined = lookup(result, key, table, "value", {"cnt": out}, self.getHow(), TableSize(*size))
            result = joined.withColumn(out, F.coalesce(quoted(out), F.lit(0)).cast("double"))
        return result

    def write(self):
        return _FrequencyWriter(self)

    @classmethod
    def read(cls):
        return _FrequencyReader(cls)


class _FrequencyWriter(DefaultParamsWriter):
    """Metadata plus the counts, so that a saved model stands alone."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.tables(self.sparkSession).write.partitionBy("column").parquet(path + "/data")


class _FrequencyReader(DefaultParamsReader):
    def load(self, path: str) -> FrequencyEncoderModel:
        return super().load(path).setTablePath(path + "/data")


class WideIndexer(FrequencyEncoder):
    """Index categories of any number: by count, then value, as Spark's ``StringIndexer`` does by default.

    The labels are a table in the shared folder, numbered without sorting a column in one task; the driver
    holds only their number. Null is no label. Values are compared as text.
    """

    def fit_counts(self, counts: DataFrame) -> "WideIndexerModel":
        """Learn from value counts, ``column, value, cnt``, made before; other columns' are left out."""
        own = counts.where(F.col("column").isin(self.getInputCols()))
        ranked = category_index(own).select("column", "value", F.col("idx").alias("cnt"))
        fitted = super().fit_counts(ranked)
        model = WideIndexerModel(inputCols=self.getInputCols(), outputCols=self.getOutputCols())
        return model.setTablePath(fitted.getTablePath()).setSizes(fitted.getSizes())


class WideIndexerModel(FrequencyEncoderModel):
    """Add the index of each value as a double; null and unseen values have the number of labels.

    Rows find their index by :func:`trainflow.operators.lookup.lookup`: small tables are broadcast, beyond
    that both sides are shuffled with hot keys salted. No row is lost.
    """

    def categories(self) -> dict[str, int]:
        """Number of labels of each input column."""
        return {c: size[0] for c, size in zip(self.getInputCols(), self.getSizes())}

    def labels(self, spark) -> DataFrame:
        """``column, value, idx``."""
        return self.tables(spark).select("column", "value", F.col("cnt").alias("idx"))

    def one_hot(self, spark, outputCols: Sequence[str]) -> "WideOneHot":
        """The stage that makes sparse vectors of the indexes, one slot per label; null and unseen
        values have none. It needs the numbers of labels alone: no pass over the rows."""
        sizes = list(self.categories().values())
        return WideOneHot(inputCols=self.getOutputCols(), outputCols=list(outputCols), sizes=sizes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        result = dataset
        for c, out, size in zip(self.getInputCols(), self.getOutputCols(), self.getSizes()):
            table = self.table(dataset.sparkSession, c)
            joined = lookup(result, quoted(c).cast("string"), table, "value", {"cnt": out}, "left", TableSize(*size))
            result = joined.withColumn(out, F.coalesce(quoted(out), F.lit(size[0])).cast("double"))
        return result


class WideOneHot(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Sparse one-hot vectors of indexes of any number of labels; an index outside of them has no slot.

    Spark's ``OneHotEncoder`` gives the same vectors, but names every slot in the column's metadata, which the
    driver makes and holds. Here the metadata has the number of slots alone.
    """

    sizes = Param(Params._dummy(), "sizes", "number of labels of each input column", typeConverter=TypeConverters.toListInt)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        sizes: Sequence[int] | None = None,
    ):
        super().__init__()
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        sizes: Sequence[int] | None = None,
    ):
        return self._set(**self._input_kwargs)

    def getSizes(self) -> list[int]:
        return self.getOrDefault(self.sizes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = zip(self.getInputCols(), self.getOutputCols(), self.getSizes(), strict=True)
        return dataset.withColumns({out: _slot_vector(quoted(c).cast("long"), size, out) for c, out, size in columns})


def _slot_vector(index: Column, size: int, name: str) -> Column:
    """The index as a sparse vector of ``size`` slots, with their number as metadata."""
    inside = F.coalesce((index >= 0) & (index < size), F.lit(False))
    # Written as the fields of a vector and read as one: no row goes through Python.
    start = f'{{"v":{{"type":0,"size":{size},"indices":['
    slot = F.concat(F.lit(start), index.cast("string"), F.lit('],"values":[1.0]}}'))
    text = F.when(inside, slot).otherwise(F.lit(f'{start}],"values":[]}}}}'))
    vector = F.from_json(text, StructType([StructField("v", VectorUDT())]))["v"]
    return vector.alias(name, metadata={"ml_attr": {"num_attrs": size}})
