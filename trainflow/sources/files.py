"""Small files at any Hadoop path, and logs of numbered entries made of them."""

from __future__ import annotations

import json
import os
import re
import uuid
from pathlib import Path
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: After so many entries a log sums itself up in one file.
SUMMARY = 64


def _system(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def full(spark: SparkSession, path: str) -> str:
    """The path with scheme and host."""
    system, at = _system(spark, path)
    return system.makeQualified(at).toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _system(spark, path)
    return system.exists(at)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds, sorted; none if it is absent."""
    system, at = _system(spark, folder)
    return sorted(x.getPath().getName() for x in system.listStatus(at)) if system.exists(at) else []


def literal(path: str) -> str:
    """A path as Spark's readers take it that is not meant to hold wildcards."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def matches(spark: SparkSession, path: str) -> list[str]:
    """Full paths that a path, which may hold wildcards, stands for; none if nothing is there."""
    system, at = _system(spark, path)
    return sorted(x.getPath().toString() for x in system.globStatus(at) or [])


def sizes_below(spark: SparkSession, folder: str) -> dict[str, int]:
    """Full paths and bytes of the files below a folder but for hidden ones; none if it is absent."""
    system, at = _system(spark, folder)
    found, root = {}, system.makeQualified(at).toString()
    if system.exists(at):
        listed = system.listFiles(at, True)
        while listed.hasNext():
            file = listed.next()
            found[file.getPath().toString()] = file.getLen()
    return {f: n for f, n in found.items() if not any(part.startswith(("_", ".")) for part in f[len(root) :].split("/"))}


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """Full paths of the files below a folder, sorted, but for hidden ones; none if it is absent."""
    return sorted(sizes_below(spark, folder))


def delete(spark: SparkSession, path: str) -> None:
    system, at = _system(spark, path)
    system.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small file; None if it is absent."""
    system, at = _system(spark, path)
    if not system.exists(at):
        return None
    with_stream = system.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(with_stream)).decode()
    finally:
        with_stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    system, at = _system(spark, path)
    stream = system.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _rename(spark: SparkSession, source: str, target: str) -> None:
    system, at = _system(spark, target)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(spark._jvm.org.apache.hadoop.fs.Path(source), at, options)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file, with folders above the target made first; a target that is there is an error.

    From one file system to another the file is copied under a hidden name, which then is renamed.
    """
    (here, file), (there, at) = _system(spark, source), _system(spark, target)
    there.mkdirs(at.getParent())
    if here.getUri().equals(there.getUri()):
        _rename(spark, source, target)
        return
    draft = f"{target.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(here, file, there, _system(spark, draft)[1], False, conf)
    _rename(spark, draft, target)
    here.delete(file, False)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that was not there, whole; False if somebody else did so first.

    A hidden file beside it gets the text and then the name, which one writer alone can give: by a hard
    link on a local disk, by a rename that does not overwrite elsewhere. HDFS renames atomically; a
    store that copies instead of renaming gives no such guarantee.
    """
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    local = urlparse(full(spark, path))
    if local.scheme == "file":
        at = Path(unquote(local.path))
        hidden = at.with_name(draft.rpartition("/")[2])
        at.parent.mkdir(parents=True, exist_ok=True)
        hidden.write_text(text)
        try:
            os.link(hidden, at)
        except FileExistsError:
            return False
        finally:
            hidden.unlink()
        return True
    if exists(spark, path):
        return False
    _write(spark, draft, text)
    try:
        _rename(spark, draft, path)
    except Py4JJavaError as error:
        delete(spark, draft)
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


class Conflict(RuntimeError):
    """Somebody else wrote the entry that was to be written."""


class NumberedLog:
    """Entries, as JSON objects, that are written once each under consecutive numbers from 1.

    Whoever creates the file of a number first has it, so two writers never both do. A reader lists the
    folder, and reads the newest summary and the entries after it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, number: int, kind: str = "json") -> str:
        return f"{self.folder}/{number:020d}.{kind}"

    def entries(self) -> list[dict]:
        """All entries in order, each with its ``number``."""
        held = [(int(n.partition(".")[0]), n.partition(".")[2]) for n in names(self.spark, self.folder) if n[:1].isdigit()]
        summed = max((n for n, kind in held if kind == "all"), default=0)
        found = []
        if summed:
            found = [json.loads(line) for line in read_text(self.spark, self._path(summed, "all")).splitlines()]
        for number in sorted(n for n, kind in held if kind == "json" and n > summed):
            found.append(json.loads(read_text(self.spark, self._path(number))) | {"number": number})
        return found

    def last(self) -> int:
        return max((int(n.partition(".")[0]) for n in names(self.spark, self.folder) if n.endswith(".json")), default=0)

    def append(self, entry: dict, after: int | None = None) -> int:
        """Writes an entry and returns its number. With ``after``, the number of the last entry the writer
        has seen, raises :class:`Conflict` if there is a later one."""
        number = self.last() if after is None else after
        while True:
            number += 1
            if create_new(self.spark, self._path(number), json.dumps(entry)):
                break
            if after is not None:
                raise Conflict(f"entry {number} of {self.folder} was written by somebody else")
        if number % SUMMARY == 0:
            # Entries never change, so whoever sums them up writes the same.
            lines = [json.dumps(e) for e in self.entries() if e["number"] <= number]
            create_new(self.spark, self._path(number, "all"), "\n".join(lines))
        return number
