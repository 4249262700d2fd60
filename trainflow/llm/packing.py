"""Documents packed into sequences of fixed length by patterns fitted to the histogram of lengths.

A pattern is a few lengths that fill a sequence exactly. Non-negative least squares says how often
to repeat each pattern so that together they use up the histogram; counts are rounded down, limited
to what is there, and what is left over is packed best fit first, longest piece first. All of that sees
only counts by length, at most ``size`` numbers. Pieces then take their places in parallel: the j-th
piece of a length takes the j-th slot of that length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trainflow.llm.tokens import encoder
from trainflow.workspace import written

#: Steps of the least-squares fit, and pieces numbered together.
STEPS = 400
TOGETHER = 50_000

Pattern = tuple[int, ...]


def patterns(present: np.ndarray, size: int) -> np.ndarray:
    """All sets of one, two or three present lengths that add up to ``size``; absent places are 0."""
    there = np.zeros(size + 1, bool)
    there[present] = True
    there[0] = True  # no piece: the pattern has fewer lengths
    a, b = np.meshgrid(np.flatnonzero(there), np.flatnonzero(there), indexing="ij")
    c = size - a - b
    ok = (a <= b) & (b <= c) & (c >= 0)
    a, b, c = a[ok], b[ok], c[ok]
    ok = there[c]
    return np.stack((a[ok], b[ok], c[ok]), axis=1)


def fitted(shapes: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeat counts that come nearest to the histogram, none negative (accelerated projected gradient)."""
    counts = histogram.astype(float).copy()
    counts[0] = 0
    used = shapes > 0

    def made(x: np.ndarray) -> np.ndarray:
        return np.bincount(shapes[used], np.broadcast_to(x[:, None], shapes.shape)[used], len(counts))

    x = y = np.zeros(len(shapes))
    if not len(shapes):
        return x
    # The largest eigenvalue is at most the largest row sum of the matrix times its transpose.
    step = 1 / max(1.0, float((made(np.ones(len(shapes))) * 3).max()))
    pace = 1.0
    for _ in range(STEPS):
        gap = counts - made(y)
        gap[0] = 0
        after = np.maximum(0, y + step * gap[shapes].sum(axis=1))
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        y = after + (pace - 1) / faster * (after - x)
        x, pace = after, faster
    return x


def best_fit(histogram: dict[int, int], size: int) -> dict[Pattern, int]:
    """Best fit decreasing on counts: equal pieces in equal sequences are placed together."""
    open_by_room: dict[int, dict[Pattern, int]] = defaultdict(dict)
    closed: dict[Pattern, int] = defaultdict(int)

    def put(shape: Pattern, many: int) -> None:
        room = size - sum(shape)
        kind = open_by_room[room] if room else closed
        kind[shape] = kind.get(shape, 0) + many

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = min((r for r, kinds in open_by_room.items() if r >= length and kinds), default=None)
            if room is None:
                fit = size // length
                if left >= fit:
                    put((length,) * fit, left // fit)
                if left % fit:
                    put((length,) * (left % fit), 1)
                break
            shape, many = open_by_room[room].popitem()
            take = min(many, left)
            if many > take:
                open_by_room[room][shape] = many - take
            put((*shape, length), take)
            left -= take
    for kinds in open_by_room.values():
        for shape, many in kinds.items():
            closed[shape] += many
    return dict(closed)


def planned(histogram: dict[int, int], size: int) -> dict[Pattern, int]:
    """How many sequences have which lengths; together they hold the histogram exactly."""
    left = np.zeros(size + 1, np.int64)
    for length, many in histogram.items():
        left[length] = many
    shapes = patterns(np.flatnonzero(left), size)
    wanted = np.floor(fitted(shapes, left)).astype(np.int64)
    plan: dict[Pattern, int] = {}
    for i in np.argsort(-wanted, kind="stable"):
        if not wanted[i]:
            break
        shape = tuple(int(v) for v in shapes[i] if v)
        many = min(int(wanted[i]), *(int(left[v]) // shape.count(v) for v in shape))
        if many:
            plan[shape] = many
            for v in shape:
                left[v] -= many
    for shape, many in best_fit({v: int(left[v]) for v in np.flatnonzero(left).tolist()}, size).items():
        plan[shape] = plan.get(shape, 0) + many
    return plan


class Slots:
    """Where the j-th piece of a length goes."""

    def __init__(self, plan: dict[Pattern, int]) -> None:
        taken: dict[int, int] = defaultdict(int)
        rows, sequence = [], 0
        for shape in sorted(plan):
            offset = 0
            for length in shape:
                rows.append((length, taken[length], sequence, offset))
                taken[length] += plan[shape]
                offset += length
            sequence += plan[shape]
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4)
        self.length, self.first, self.sequence, self.offset = table.T.copy()
        self.bounds = np.searchsorted(self.length, np.arange(self.length[-1] + 2 if len(rows) else 1))

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.empty(len(length), np.int64)
        for v in np.unique(length).tolist():
            of = length == v
            low, high = self.bounds[v], self.bounds[v + 1]
            row[of] = low + np.searchsorted(self.first[low:high], number[of], "right") - 1
        return self.sequence[row] + number - self.first[row], self.offset[row]


def pieces(
    docs: DataFrame,
    definition: str,
    end: int,
    key: str = "doc_id",
    text: str = "text",
    size: int = 1024,
    ids: bool = False,
    as_text: bool = True,
) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` of every document, with ``ids`` if asked for.

    A document is the ids of its text and the end id. One longer than ``size`` is cut so that all
    pieces but the first have ``size`` ids. A null or empty text is the end id alone.
    Special tokens in a text are text with ``as_text``, else what the library makes of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value, as_text)
        for batch in batches:
            rows, counts, values = [], [], []
            for got in own.encode(batch.column(1).to_pylist()):
                got = np.append(got, np.uint32(end)).astype("<u4")
                cuts = [0, *range((len(got) - 1) % size + 1, len(got) + 1, size)]
                counts.append(len(cuts) - 1)
                for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    rows.append((piece, a, b - a, zlib.crc32(got[a:b])))
                if ids:
                    values.append(got)
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            table = np.array(rows, np.int64).reshape(-1, 4)
            columns = [keys, pa.array(table[:, 0].astype(np.int32)), *(pa.array(table[:, i]) for i in (1, 2, 3))]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if ids:
                flat = np.concatenate([np.empty(0, "<u4"), *values]).astype(np.int64)
                bounds = pa.array(np.concatenate(([0], np.cumsum(table[:, 2]))).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(bounds, pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * ids
    return docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("__t")).mapInArrow(run, schema)


def packed(cut: DataFrame, key: str = "doc_id", size: int = 1024) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with ``key, piece, start, length``.

    Every sequence has at most ``size`` ids, its pieces lie one after the other from 0, and every
    piece, repeated ones too, has one place. No pieces give no rows.
    """
    spark = cut.sparkSession
    rows = written(cut, "pieces")
    total = rows.count()
    bucket = F.pmod(F.xxhash64(key, "piece"), F.lit(max(1, total // TOGETHER)))
    rows = rows.withColumn("__bucket", bucket)
    groups = rows.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("__many"))
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.sparkContext.broadcast(Slots(planned(histogram, size)))
    earlier = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = groups.select("length", "__bucket", F.coalesce(F.sum("__many").over(earlier), F.lit(0)).alias("__first"))
    order = Window.partitionBy("length", "__bucket").orderBy(key, "piece", "start", "ids_crc32")
    numbered = rows.withColumn("__own", F.row_number().over(order)).join(firsts, ["length", "__bucket"])
    numbered = numbered.withColumn("__number", F.col("__first") + F.col("__own") - 1)
    numbered = numbered.select(*cut.columns, "__number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = cut_names.index("length")
        for batch in batches:
            length, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (at, batch.num_columns - 1))
            sequence, offset = slots.value.place(length, number)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*cut_names, "sequence_id", "offset"]
            )

    cut_names = cut.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return numbered.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(
    docs: DataFrame,
    definition: str,
    end: int,
    key: str = "doc_id",
    text: str = "text",
    size: int = 1024,
    ids: bool = False,
    as_text: bool = True,
) -> DataFrame:
    """The pieces of all documents with their places; see ``pieces`` and ``packed``.

    Null keys and repeated rows are packed like any other; other columns are not carried; an empty
    table gives no rows.
    """
    return packed(pieces(docs, definition, end, key, text, size, ids, as_text), key, size)
