"""JSON arrays of any size, cut into their elements as they are written.

A structural index of a block of text (quotes by parity, brackets by prefix sums) tells where the
elements of an array end. A line that is no array is one payload. Files of up to ``WHOLE`` bytes are
read line by line. Larger ones, as one line of them may be the whole file, are read in Spark's own
splits at every closing brace: a first pass sums up what each split does to a line that is open at
its start, from which follows the state each split starts in; a second one cuts all splits at once,
and puts together the elements that reach over the end of a split.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trainflow.sources import files
from trainflow.workspace import written

#: Bytes up to which a file is read line by line, and bytes that are indexed at once.
WHOLE, BLOCK = 1 << 26, 1 << 20
SPACE, TRIMMED = b" \t\r\n", r"BOTH ' \t\r\n'"


@dataclass
class State:
    """Of a line that is open: whether it is an array (unknown before its first character), whether a
    string is open, how deep brackets are nested, whether the array has ended, whether a backslash came last."""

    array: bool | None = None
    quoted: bool = False
    depth: int = 0
    closed: bool = False
    escaped: bool = False


def _unescaped(data: np.ndarray, byte: int, escaped: bool) -> np.ndarray:
    """Positions of a byte that no backslash escapes."""
    at = np.flatnonzero(data == byte)
    slashes = np.flatnonzero(data == 0x5C)
    if not len(slashes):
        return at[1:] if escaped and len(at) and at[0] == 0 else at
    # Runs of backslashes: what follows one of odd length is escaped.
    first = np.flatnonzero(np.concatenate(([True], np.diff(slashes) > 1)))
    starts, sizes = slashes[first], np.diff(np.append(first, len(slashes)))
    if escaped and starts[0] == 0:
        sizes[0] += 1
    behind = (starts + np.diff(np.append(first, len(slashes))))[sizes % 2 == 1]
    at = at[~np.isin(at, behind)]
    return at[1:] if escaped and len(at) and at[0] == 0 else at


def _ends_escaped(data: bytes, escaped: bool) -> bool:
    run = len(data) - len(data.rstrip(b"\\"))
    return (run + (escaped and run == len(data))) % 2 == 1


def _brackets(data: np.ndarray, quoted: bool, escaped: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Positions of brackets and commas outside of strings, what they do to the depth, and whether a
    string is open at the end."""
    quotes = _unescaped(data, 0x22, escaped)
    kinds = STEP[data]
    at = np.flatnonzero(kinds)
    inside = (np.searchsorted(quotes, at) + quoted) % 2 == 1
    at = at[~inside]
    steps = kinds[at]
    return at, np.where(steps == 2, 0, steps), bool((len(quotes) + quoted) % 2)


#: 1 for opening brackets, -1 for closing ones, 2 for commas.
STEP = np.zeros(256, np.int8)
STEP[[0x5B, 0x7B]], STEP[[0x5D, 0x7D]], STEP[0x2C] = 1, -1, 2


def cuts(text: bytes, state: State) -> list[bytes]:
    """Cuts a piece of one line (no line feed in it) where elements end, and moves the state along.

    The first part goes on with what was open before, the last one is open. The bracket that begins the
    array, the one that ends it and the commas between are in no part.
    """
    if state.array is None:
        head = text.lstrip(SPACE)
        if not head:
            return [text]
        state.array = head[:1] == b"["
        if state.array:
            text, state.depth = head[1:], 1
    if not state.array or state.closed:
        return [text]
    parts, start = [], 0
    for k in range(0, len(text), BLOCK):
        block = text[k : k + BLOCK]
        at, steps, state.quoted = _brackets(np.frombuffer(block, np.uint8), state.quoted, state.escaped)
        state.escaped = _ends_escaped(block, state.escaped)
        depth = state.depth + np.cumsum(steps)
        ended = np.flatnonzero(depth == 0)
        if len(ended):
            at, steps, depth, state.closed = at[: ended[0] + 1], steps[: ended[0] + 1], depth[: ended[0] + 1], True
        state.depth = int(depth[-1]) if len(depth) else state.depth
        for place in (at[((steps == 0) & (depth == 1)) | (depth == 0)] + k).tolist():
            parts.append(text[start:place])
            start = place + 1
        if state.closed:
            break
    return [*parts, text[start:]]


def payloads(line: bytes) -> list[bytes]:
    """The payloads of a whole line: the elements of an array, each as it is written, or the line itself.

    An array that is cut off has its elements and what is left of the last; text behind an array is a
    payload too. Blank ones are none: a comma too many is passed over.
    """
    return [x for x in (part.strip(SPACE) for part in cuts(line, State())) if x]


def elements(lines: DataFrame, text: str = "value") -> DataFrame:
    """``payload``: of lines that were read whole. Blank lines and empty arrays have none."""

    @F.arrow_udf("array<binary>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else payloads(t) for t in texts.to_pylist()], pa.list_(pa.binary()))

    trimmed = F.expr(f"trim({TRIMMED} FROM `{text}`)")
    # Only arrays are sent to Python.
    many = split(F.when(trimmed.startswith("["), trimmed.cast("binary")))
    one = F.when(~trimmed.startswith("["), F.array(trimmed.cast("binary")))
    found = lines.where(trimmed != "").select(F.explode(F.coalesce(one, many)).alias("payload"))
    return found.select(F.col("payload").cast("string").alias("payload"))


# Splits of large files.

SUMMARY = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("feed", pa.bool_())]
    + [("array", pa.bool_()), ("quoted", pa.bool_()), ("depth", pa.int64()), ("closed", pa.bool_())]
    + [(f"{n}{h}", t) for h in (0, 1) for n, t in (("quoted", pa.bool_()), ("delta", pa.int64()), ("low", pa.int64()))]
)
START = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("array", pa.bool_()), ("quoted", pa.bool_()), ("depth", pa.int64())]
    + [("closed", pa.bool_()), ("first", pa.bool_()), ("last", pa.bool_()), ("brace", pa.bool_()), ("bytes", pa.int64())]
)
PARTS = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("place", pa.int32()), ("opens", pa.bool_()), ("text", pa.binary())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text between closing braces, in the order of the file within each of Spark's splits."""
    about = {"file": "file_path", "block": "file_block_start", "size": "file_size"}
    rows = spark.read.option("lineSep", "}").text(paths)
    return rows.select(F.col("value").cast("binary").alias("value"), *(F.col(f"_metadata.{f}").alias(n) for n, f in about.items()))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """What the pieces of a split share, and their text with a brace after each, some pieces at once."""
    for batch in batches:
        shared = list(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True))
        i = 0
        while i < len(shared):
            texts, size, j = [], 0, i
            while j < len(shared) and shared[j] == shared[i] and size < BLOCK:
                texts.append(batch.column(0)[j].as_py())
                size += len(texts[-1])
                j += 1
            yield shared[i], b"}".join([*texts, b""])
            i = j


class _Unknown:
    """What text of a line does if nothing is known before it: for both answers to whether a string is
    open at its start, if one is at its end, the change of depth, and the lowest change on the way."""

    def __init__(self):
        self.quoted, self.delta, self.low, self.escaped = [False, True], [0, 0], [0, 0], False

    def add(self, text: bytes) -> None:
        data = np.frombuffer(text, np.uint8)
        for h in (0, 1):
            _, steps, self.quoted[h] = _brackets(data, self.quoted[h], self.escaped)
            way = np.cumsum(steps)
            if len(way):
                self.low[h] = min(self.low[h], self.delta[h] + int(way.min()))
                self.delta[h] += int(way[-1])
        self.escaped = _ends_escaped(text, self.escaped)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: whether a line ends in it, the state of the last line if it begins here or
    has been blank before, and what the split does to it otherwise."""

    def row() -> pa.RecordBatch:
        either = [v for h in (0, 1) for v in (line.quoted[h], line.delta[h], line.low[h])]
        return _batch([(*key, n, feed, own.array, own.quoted, own.depth, own.closed, *either)], SUMMARY)

    key = None
    for shared, chunk in _chunks(batches):
        if shared != key:
            if key:
                yield row()
            key, n, feed, own, line = shared, 0, False, State(), _Unknown()
        n += len(chunk)
        _, sep, tail = chunk.rpartition(b"\n")
        if sep:
            feed, own = True, State()
        cuts(tail, own)
        if not feed:
            line.add(tail)
    if key:
        yield row()


def _started(table: pa.Table) -> pa.Table:
    """The state that each split of one file starts in, from the summaries of all its splits."""
    splits, out, state = sorted(table.to_pylist(), key=lambda r: r["block"]), [], State()
    # The pieces were counted with a brace each.
    brace = sum(r["bytes"] for r in splits) == splits[0]["size"]
    for i, r in enumerate(splits):
        place = (i == 0, i == len(splits) - 1, brace, r["bytes"])
        out.append((r["file"], r["block"], state.array, state.quoted, state.depth, state.closed, *place))
        if r["feed"] or state.array is None:
            state = State(r["array"], r["quoted"], r["depth"], r["closed"])
        elif state.array and not state.closed:
            h = int(state.quoted)
            state = State(True, r[f"quoted{h}"], state.depth + r[f"delta{h}"], state.depth + r[f"low{h}"] <= 0)
    return pa.Table.from_batches([_batch(out, START)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The payloads of each split, with no ``place``, and the parts that reach over its start or end:
    ``opens`` if they begin here."""
    chunks = _chunks(batches)
    now = next(chunks, None)
    key, out, size = None, [], 0
    while now is not None:
        (shared, chunk), now = now, next(chunks, None)
        file, block, _, array, quoted, depth, closed, first, last, brace, size_before = shared
        if shared != key:
            key, state, held, fresh, place, n_bytes = shared, State(array, quoted, depth, closed), [], first, 0, 0
        over, n_bytes = now is None or now[0] != key, n_bytes + len(chunk)
        if size_before is None or (over and n_bytes != size_before):
            raise RuntimeError(f"the splits of {file} are not those of the first pass; run again with steady settings")
        if over and last and not brace:
            chunk = chunk[:-1]  # the file does not end with a brace

        def end() -> None:
            nonlocal held, fresh, place, size
            text = b"".join(held)
            size += len(text)
            if not fresh:
                out.append((file, block, place, False, text))
                place += 1
            elif text := text.strip(SPACE):
                out.append((file, block, None, None, text))
            held, fresh = [], True

        for n, line in enumerate(chunk.split(b"\n")):
            if n:
                end()
                state = State()
            for k, part in enumerate(cuts(line, state)):
                if k:
                    end()
                held.append(part)
        if over and last:
            end()
        elif over:
            out.append((file, block, place, fresh, b"".join(held)))
        if out and (size >= BLOCK or over):
            yield _batch(out, PARTS)
            out, size = [], 0


def _ddl(schema: pa.Schema) -> str:
    kinds = {"string": "string", "int64": "long", "int32": "int", "bool": "boolean", "binary": "binary"}
    return ", ".join(f"{f.name} {kinds[str(f.type)]}" for f in schema)


def split_payloads(spark: SparkSession, sizes: dict[str, int], splits_at_once: int = 50_000) -> DataFrame:
    """``payload``: those of large files, given with their bytes, read in Spark's splits whatever their lines are.

    The starting states of about ``splits_at_once`` splits are sent to every executor; what has more is
    read in several groups of files. Only elements that reach over the end of a split are dealt out. Both
    passes must see the same splits, which is checked.
    """
    most = splits_at_once * spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    groups, held = [[]], 0
    for file, size in sorted(sizes.items()):
        if groups[-1] and held + size > most:
            groups, held = [*groups, []], 0
        groups[-1].append(files.literal(file))
        held += size
    found = spark.createDataFrame([], "payload string")
    for group in groups:
        summed = _pieces(spark, group).mapInArrow(_summed, _ddl(SUMMARY))
        starts = written(summed.groupBy("file").applyInArrow(_started, _ddl(START)), "starts")
        pieces = _pieces(spark, group).join(F.broadcast(starts), ["file", "block"], "left")
        cut = pieces.select("value", "file", "block", "size", *START.names[2:]).mapInArrow(_cut, _ddl(PARTS))
        cut = written(cut, "parts")
        # Of a part that reaches over splits each has one row.
        order = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, 0)
        open_parts = cut.where("place IS NOT NULL").withColumn("part", F.sum(F.col("opens").cast("int")).over(order))
        pieces_of = F.sort_array(F.collect_list(F.struct("block", "place", "text")))
        # Parts begin and end at ASCII characters.
        text = F.array_join(F.transform(pieces_of, lambda x: x["text"].cast("string")), "")
        joined = open_parts.groupBy("file", "part").agg(text.alias("payload"))
        joined = joined.select(F.expr(f"trim({TRIMMED} FROM payload)").alias("payload")).where("payload <> ''")
        whole = cut.where("place IS NULL").select(F.col("text").cast("string").alias("payload"))
        found = found.unionByName(whole).unionByName(joined)
    return found


def read_payloads(spark: SparkSession, paths: str | Sequence[str], whole: int | None = None) -> DataFrame:
    """``payload``: all of the files at some paths; none if nothing is there.

    Files of at most ``whole`` bytes are read line by line; the result is the same.
    """
    given, limit = [paths] if isinstance(paths, str) else list(paths), WHOLE if whole is None else whole
    sizes = {f: n for p in given for root in files.matches(spark, p) for f, n in files.sizes_below(spark, root).items()}
    large = {f: n for f, n in sizes.items() if n > limit}
    if not sizes:
        return spark.createDataFrame([], "payload string")
    if not large:
        return elements(spark.read.text([p for p in given if files.matches(spark, p)]))
    found = split_payloads(spark, large)
    small = sorted(set(sizes) - set(large))
    return found.unionByName(elements(spark.read.text([files.literal(f) for f in small]))) if small else found
