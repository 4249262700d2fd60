"""Token ids as files of length-delimited binary records, with an index of offsets beside each.

A record is: payload length (unsigned 64-bit), masked checksum of those 8 bytes (unsigned 32-bit),
payload, masked checksum of the payload; all little-endian. A checksum is the CRC-32 of zlib, rotated
right by 15 bits plus a constant, so that a stored checksum is not mistaken for data. The payload is
the document's ids, 2 bytes each if the vocabulary allows it and 4 bytes otherwise. The index has 40
bytes a record: key, 1 if the key is not null, ids in the file before it, offset, payload length.

Each task writes one file and one index of its range of keys below the shared folder, by any file
system that the Arrow library knows. Names hold the task attempt: a repeated task leaves its first
file unused, as only files listed by finished tasks are in the table of files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trainflow.llm.tokens import encoder
from trainflow.workspace import new_folder, written

#: Fixed values of the format.
HEAD, TAIL = struct.Struct("<QI"), struct.Struct("<I")
MASK = 0xA282EAD8
FRAME = HEAD.size + TAIL.size
INDEX = np.dtype([("key", "<i8"), ("has_key", "<u8"), ("start", "<u8"), ("offset", "<u8"), ("size", "<u8")])
#: Bytes read or written at once.
BUFFER = 1 << 22

FILES = "part int, path string, bytes long, records long, tokens long"
RECORDS = "key long, start long, ids array<long>"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, TAIL.pack(masked(length)), payload, TAIL.pack(masked(payload))))


def unframed(stream, expected: int | None = None) -> bytes:
    """The payload of the record at the stream's place; a damaged record raises."""
    head = stream.read(HEAD.size)
    if len(head) < HEAD.size:
        raise ValueError("record cut off")
    size, check = HEAD.unpack(head)
    if masked(head[:8]) != check or expected not in (None, size):
        raise ValueError("damaged record length")
    payload, tail = stream.read(size), stream.read(TAIL.size)
    if len(payload) < size or len(tail) < TAIL.size or TAIL.unpack(tail)[0] != masked(payload):
        raise ValueError("damaged record")
    return payload


def _opened(path: str):
    return pafs.FileSystem.from_uri(path)


def write(
    docs: DataFrame,
    definition: str,
    end: int,
    key: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
    as_text: bool = True,
) -> DataFrame:
    """Writes the ids of every text in ascending order of the key; returns the table of files.

    ``definition`` is a tokenizer of the tokenizers library as JSON, ``end`` the id appended to each
    document. Special tokens in a text are text with ``as_text``, else what the library makes of them. Null and empty texts have the end id alone. Null keys come first; rows with the same
    key are ordered by a digest of their text. Other columns are not written. An empty table gives no files.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "records")
    shared = spark.sparkContext.broadcast(definition)
    wide = max(encoder(definition, as_text).library.get_vocab_size(), end + 1) > 1 << 16
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        system, base = _opened(folder)
        system.create_dir(base, recursive=True)
        own, offset, tokens, records = encoder(shared.value, as_text), 0, 0, 0
        with (
            system.open_output_stream(f"{base}/{stem}.rec", buffer_size=BUFFER) as data,
            system.open_output_stream(f"{base}/{stem}.idx", buffer_size=BUFFER) as index,
        ):
            for batch in batches:
                keys = batch.column(0)
                rows = np.zeros(len(keys), INDEX)
                rows["key"] = keys.fill_null(0).to_numpy(zero_copy_only=False)
                rows["has_key"] = keys.is_valid().to_numpy(zero_copy_only=False)
                for i, ids in enumerate(own.encode(batch.column(1).to_pylist())):
                    payload = np.append(ids, np.uint32(end)).astype(kind).tobytes()
                    data.write(frame(payload))
                    rows[i]["start"], rows[i]["offset"], rows[i]["size"] = tokens, offset, len(payload)
                    offset += FRAME + len(payload)
                    tokens += len(ids) + 1
                index.write(rows.tobytes())
                records += len(rows)
        values = [[task.partitionId()], [f"{folder}/{stem}"], [offset], [records], [tokens]]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = ["part", "path", "bytes", "records", "tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)

    tie = F.xxhash64("t")
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    ranged = rows.repartitionByRange(F.asc_nulls_first("k"), tie).sortWithinPartitions(F.asc_nulls_first("k"), tie)
    files = written(ranged.mapInArrow(run, FILES).where("records > 0"), "files")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    width = F.lit(4 if wide else 2)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).withColumn("width", width)


def _record(batch_rows: list[tuple]) -> pa.RecordBatch:
    keys, starts, ids = zip(*batch_rows, strict=True)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
    values = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids).astype(np.int64)))
    columns = [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), values]
    return pa.RecordBatch.from_arrays(columns, names=["key", "start", "ids"])


def _index(path: str) -> np.ndarray:
    system, base = _opened(path)
    with system.open_input_stream(f"{base}.idx") as stream:
        return np.frombuffer(stream.read(), INDEX)


def _key(entry: np.void) -> int | None:
    return int(entry["key"]) if entry["has_key"] else None


def _file_records(file: dict) -> Iterator[tuple]:
    """Key, ids before it and ids of every record of a file, in order."""
    system, base = _opened(file["path"])
    with system.open_input_stream(f"{base}.rec", buffer_size=BUFFER) as stream:
        for entry in _index(file["path"]):
            ids = np.frombuffer(unframed(stream, int(entry["size"])), f"<u{file['width']}")
            yield _key(entry), file["start"] + int(entry["start"]), ids


def _spread(files: DataFrame) -> DataFrame:
    """The table of files with about one file in each partition."""
    return files.select("path", "start", "width").repartitionByRange(max(1, files.count()), "path")


def read(files: DataFrame) -> DataFrame:
    """``key, start, ids`` of every record, read from the files in order; ``start``: ids before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                out, held = [], 0
                for record in _file_records(file):
                    out.append(record)
                    held += len(record[2])
                    if held >= 1 << 18:
                        yield _record(out)
                        out, held = [], 0
                if out:
                    yield _record(out)

    return _spread(files).mapInArrow(run, RECORDS)


def read_shuffled(files: DataFrame, seed: int) -> DataFrame:
    """The same records in an order drawn by the seed, each fetched by its offset in the index."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                rows = _index(file["path"])
                for k in range(0, len(rows), 1 << 16):
                    part = rows[k : k + (1 << 16)]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "path": [file["path"]] * len(part),
                            "width": pa.array([file["width"]] * len(part), pa.int32()),
                            "key": pa.array([_key(e) for e in part], pa.int64()),
                            "start": pa.array(part["start"].astype(np.int64) + file["start"]),
                            "offset": pa.array(part["offset"].astype(np.int64)),
                            "size": pa.array(part["size"].astype(np.int64)),
                        }
                    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                out = []
                for e in batch.slice(k, 256).to_pylist():
                    system, base = _opened(e["path"])
                    with system.open_input_file(f"{base}.rec") as stream:
                        stream.seek(e["offset"])
                        ids = np.frombuffer(unframed(stream, e["size"]), f"<u{e['width']}")
                    out.append((e["key"], e["start"], ids))
                yield _record(out)

    index = _spread(files).mapInArrow(entries, "path string, width int, key long, start long, offset long, size long")
    drawn = F.xxhash64(F.lit(seed), "path", "offset")
    return index.repartitionByRange(drawn).sortWithinPartitions(drawn).mapInArrow(fetch, RECORDS)


def summary(files: DataFrame) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every record, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                rows = [(k, start, len(ids), zlib.crc32(ids.astype("<u4"))) for k, start, ids in _file_records(file)]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "n_tokens", "ids_crc32"])

    return _spread(files).mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")


def round_trip(spark: SparkSession, docs: DataFrame, definition: str, end: int, as_text: bool = True) -> DataFrame:
    """Writes the documents' ids and returns the summary read back from the files."""
    return summary(write(docs, definition, end, as_text=as_text)).withColumnRenamed("key", "doc_id")
