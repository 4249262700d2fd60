"""Files: inventory by extension, and which inputs have the columns needed."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainflow.sources import files

#: Footers that the driver reads at once.
FOOTERS = 32
# Where Spark keeps its schema in a file, and what Parquet's reader says of broken files.
SPARK_SCHEMA = "org.apache.spark.sql.parquet.row.metadata"
BROKEN = ("is not a Parquet file", "can not read class org.apache.parquet", "corrupted file")


def file_inventory(spark: SparkSession, folder: str | Sequence[str], extension: str | None = "csv") -> DataFrame:
    """``path, length, modificationTime`` of the files with an extension; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{extension}" if extension else "*")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "modificationTime")
    )


@dataclass(frozen=True)
class Footer:
    """What a Parquet file says of itself: its schema as text and, if Spark wrote it, as Spark's JSON; or
    what is wrong with it."""

    message: str | None
    written: str | None
    problem: str | None


def _footer(spark: SparkSession, path: str) -> Footer:
    """Reads a footer by the file system that Spark reads the file with.

    Only a file that is no Parquet file, or whose footer is broken, is judged. A storage that does not
    answer raises, as the file may be good.
    """
    parquet = spark._jvm.org.apache.parquet.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    try:
        file = parquet.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = parquet.ParquetFileReader.open(file)
        try:
            found = reader.getFooter().getFileMetaData()
            return Footer(found.getSchema().toString(), found.getKeyValueMetaData().get(SPARK_SCHEMA), None)
        finally:
            reader.close()
    except Py4JJavaError as error:
        said = str(error.java_exception.getMessage())
        if not any(mark in said for mark in BROKEN):
            raise
        return Footer(None, None, f"Unreadable: {said.partition(': ')[0] if 'can not read' in said else 'no Parquet file'}")


def _nullable(kind: T.DataType) -> T.DataType:
    """A type without what a file says of nulls and comments."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def _schemas(spark: SparkSession, footers: dict[str, Footer]) -> dict[str, T.StructType]:
    """Spark's schema of each file. Files that Spark did not write are asked once for each kind of schema."""
    found, known = {}, {}
    for path, footer in footers.items():
        if footer.problem is None:
            kind = footer.written or footer.message
            if kind not in known:
                one = files.literal(path)
                read = T.StructType.fromJson(json.loads(footer.written)) if footer.written else spark.read.parquet(one).schema
                known[kind] = _nullable(read)
            found[path] = known[kind]
    return found


def _inputs(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files of each input; of nested inputs a file belongs to the inner one."""
    roots = {p: files.matches(spark, p) for p in dict.fromkeys(paths)}
    owner: dict[str, tuple[int, str]] = {}
    for given, found in roots.items():
        for root in found:
            for file in files.files_below(spark, root):
                owner[file] = max(owner.get(file, (-1, given)), (len(root), given), key=lambda x: x[0])
    owned: dict[str, list[str]] = {p: [] for p in roots}
    for file, (_, given) in owner.items():
        owned[given].append(file)
    return owned


def check_files(
    spark: SparkSession, paths: Sequence[str], required: Sequence[str], types: Callable[[T.StructType], list[str]] | None = None
) -> DataFrame:
    """``input, path, columns, schema, missing, reason`` of every file of the inputs; no reason: valid.

    Footers are read on any path that Spark reads, ``FOOTERS`` at a time; data are not. ``schema`` is that
    of Spark as JSON; ``types`` may name columns of it whose type will not do. A file that is no Parquet
    file has a reason and no schema. An input that is absent, or a folder without files, has one row:
    all columns are missing.
    """
    owned = _inputs(spark, paths)
    every = [file for found in owned.values() for file in found]
    with ThreadPoolExecutor(FOOTERS) as pool:
        footers = dict(zip(every, pool.map(lambda file: _footer(spark, file), every), strict=True))
    schemas, rows = _schemas(spark, footers), []
    for given, found in owned.items():
        if not found:
            reason = "No files" if files.matches(spark, given) else "Path does not exist"
            rows.append((given, given, None, None, sorted(required), reason))
        for file in found:
            schema = schemas.get(file)
            if schema is None:
                rows.append((given, file, None, None, None, footers[file].problem))
                continue
            missing = sorted(set(required) - set(schema.names))
            unfit = [] if missing or types is None else types(schema)
            reason = f"Missing columns: {missing}" if missing else f"Unfit types: {unfit}" if unfit else None
            rows.append((given, file, schema.names, schema.json(), missing, reason))
    return spark.createDataFrame(
        rows, "input string, path string, columns array<string>, schema string, missing array<string>, reason string"
    )


def missing_by_input(checked: DataFrame) -> dict[str, list[str]]:
    """Columns that some file of each input lacks, and what is wrong with files that are no tables or do not fit."""
    wrong = F.when(F.size("missing") > 0, F.col("missing")).when(F.col("reason").isNotNull(), F.array("reason"))
    wrong = F.coalesce(wrong, F.array().cast("array<string>"))
    each = checked.groupBy("input").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(wrong)))).alias("absent"))
    return {r["input"]: list(r["absent"]) for r in each.collect()}


def check_inputs(spark: SparkSession, paths: Sequence[str], required: Sequence[str]) -> dict[str, list[str]]:
    """Missing required columns of each input table, from the footers of all its files."""
    found = missing_by_input(check_files(spark, paths, required))
    return {path: found.get(path, sorted(required)) for path in paths}


def split_inputs(checked: dict[str, list[str]]) -> tuple[list[str], list[str]]:
    """Valid and invalid paths of a check."""
    valid = [path for path, absent in checked.items() if not absent]
    invalid = [path for path, absent in checked.items() if absent]
    return valid, invalid


def input_report(spark: SparkSession, checked: dict[str, list[str]]) -> DataFrame:
    """``path, missing_columns, valid``: one row per input."""
    rows = [(path, absent, not absent) for path, absent in checked.items()]
    return spark.createDataFrame(rows, "path string, missing_columns array<string>, valid boolean")


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows read from each file of a file-based table."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n_rows"))
