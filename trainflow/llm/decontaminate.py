"""Benchmark passages in documents, found by winnowing.

A window is ``window`` consecutive words of an item, or the whole item if it has fewer. Its
fingerprint is the smallest hash among its ``gram``-word shingles; as a window slides over a text,
that is winnowing: each run of windows with the same minimum keeps one fingerprint, and every shared
window has the same fingerprint on both sides. Documents whose fingerprint meets one of the items
pass on those windows; a join on fingerprints, and then on a 128-bit digest of the window's words,
extends the hit to exactly the shared words.

What documents are first held against is a bitmap of fixed size, whatever the number of items. It
only drops windows that no item can have; the joins decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from trainflow.functions.names import free
from trainflow.llm import words
from trainflow.workspace import written

WINDOW, GRAM = 13, 5
#: Bits of the bitmap, in pieces as Spark builds them.
BITMAP, PIECE = 1 << 25, 1 << 15
#: One of so many words must be hit.
SHARE = 20

FOUND = ArrayType(
    StructType().add("at", "integer").add("size", "integer").add("print", "long").add("digest", "binary")
)
FOUND_ARROW = pa.list_(
    pa.struct([("at", pa.int32()), ("size", pa.int32()), ("print", pa.int64()), ("digest", pa.binary())])
)


def prints(hashes: np.ndarray, size: int, gram: int) -> np.ndarray:
    """The fingerprint of each window of ``size`` words."""
    grams = words.rolled(hashes, min(gram, size))
    if len(hashes) < size:
        return grams[:0]
    out = grams[: len(hashes) - size + 1].copy()
    for k in range(1, size - min(gram, size) + 1):
        np.minimum(out, grams[k : k + len(out)], out=out)
    return words.mixed(out ^ np.uint64(size))


def _scan(
    texts: list[bytes | None], sizes: list[int] | None, window: int, gram: int, bitmap: np.ndarray | None
) -> Iterator[tuple[int, list[dict]]]:
    """The number of words and the windows found of each text. No sizes: each text is an item."""
    for _, data, at in words.grouped(texts, lower=True):
        starts, ends = words.spans(data, words.WORD)
        hashes = words.hashes(data, starts, ends)
        edges = np.searchsorted(starts, at)
        counts = np.diff(edges)
        found: list[list[dict]] = [[] for _ in counts]
        for size in sorted({min(window, n) for n in counts.tolist() if n}) if sizes is None else sizes:
            marks = prints(hashes, size, gram)
            hit = np.arange(len(marks))
            if bitmap is not None:
                place = marks & np.uint64(BITMAP - 1)
                bits = bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)
                hit = np.flatnonzero(bits & np.uint8(1))
            text = np.searchsorted(edges, hit, "right") - 1
            inside = hit + size <= edges[text + 1]
            if sizes is None:
                inside &= np.minimum(counts[text], window) == size
            for i, t in zip(hit[inside].tolist(), text[inside].tolist(), strict=True):
                spans = zip(starts[i : i + size].tolist(), ends[i : i + size].tolist(), strict=True)
                digest = xxhash.xxh3_128_digest(b" ".join([data[x:y].tobytes() for x, y in spans]))
                mark = int(marks[i].view(np.int64))
                found[t].append({"at": i - int(edges[t]), "size": size, "print": mark, "digest": digest})
        yield from zip(counts.tolist(), found, strict=True)


def _scanned(
    rows: DataFrame, sizes: list[int] | None, window: int, gram: int, bitmap: Broadcast | None
) -> DataFrame:
    """``row, k, n_words, found`` of rows ``k, t``, stored, so that row numbers stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = list(_scan(batch.column(1).to_pylist(), sizes, window, gram, bitmap and bitmap.value))
            counts = pa.array([n for n, _ in got], pa.int64())
            found = pa.array([f for _, f in got], FOUND_ARROW)
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, found], names=["k", "n_words", "found"])

    schema = StructType([StructField("k", rows.schema["k"].dataType)])
    schema.add("n_words", "long").add("found", FOUND)
    own = rows.select("k", F.col("t").cast("binary").alias("t")).mapInArrow(run, schema)
    return written(own.withColumn("row", F.monotonically_increasing_id()), "windows")


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Which fingerprints there are, by their lowest bits: 4 MB, whatever the number of windows."""
    place = F.pmod("print", F.lit(BITMAP)) + 1  # Spark numbers bits from 1
    pieces = windows.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bitmap = np.zeros(BITMAP // 8, np.uint8)
    for r in pieces.toLocalIterator():
        at = (r["piece"] - 1) * (PIECE // 8)
        bitmap[at : at + PIECE // 8] = np.frombuffer(r["bits"], np.uint8)[: len(bitmap) - at]
    return bitmap


def _covered() -> Column:
    """Words inside the spans ``hits``, each counted once."""

    def step(state: Column, hit: Column) -> Column:
        end = hit["at"] + hit["size"]
        more = F.greatest(F.lit(0), end - F.greatest(state["end"], hit["at"]))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + more).alias("n"))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort("hits"), start, step)["n"]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_words``, ``n_hit``, ``items`` and ``contaminated``.

    Words are runs of ASCII letters (A-Z taken as a-z), digits and characters beyond ASCII. ``n_hit``
    counts words inside any occurrence of an item's window; ``items`` are the keys, as sorted text,
    of items with a window that occurs (null keys as empty text); contaminated are documents with
    hits in at least one of ``SHARE`` words. Null and empty texts have no words, items without words
    no windows. Repeated rows come back repeated, repeated items count once by key. Other columns are
    not carried. Without items nothing is hit; without documents there are no rows.
    """
    tests = items.select(
        F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("k"), F.col(item_text).alias("t")
    )
    windows = _scanned(tests, None, window, gram, None).select(F.col("k").alias("item"), F.explode("found").alias("w"))
    windows = windows.select("item", "w.size", "w.print", "w.digest")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # ``window`` at most
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(windows))
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    scanned = _scanned(own, sizes, window, gram, bitmap)
    candidates = scanned.select("row", F.explode("found").alias("w"))
    hits = (
        candidates.select("row", "w.at", "w.size", "w.print", "w.digest")
        .join(windows.select("print").distinct(), "print", "left_semi")
        .join(windows.select("digest").distinct(), "digest", "left_semi")
    )
    covered = hits.groupBy("row").agg(F.collect_set(F.struct("at", "size")).alias("hits"))
    named = hits.select("row", "digest").distinct().join(windows.select("digest", "item").distinct(), "digest")
    named = named.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = covered.select("row", _covered().alias("n_hit")).join(named, "row")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        scanned.join(found, "row", "left")
        .withColumn("n_hit", n_hit)
        .select(
            F.col("k").alias(key),
            "n_words",
            "n_hit",
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        )
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not contaminated; rows without text stay."""
    digest = F.sha2(F.col(text), 256)
    own = docs.select(digest.alias("h"), F.col(text).alias("t"))
    bad = contamination(own, items, "h", "t", **options).where("contaminated")
    own_digest, other = free(docs.columns, "__digest", "__contaminated")
    bad = bad.select(F.col("h").alias(other)).distinct()
    marked = docs.withColumn(own_digest, digest)
    return marked.join(bad, F.col(own_digest) == F.col(other), "left_anti").drop(own_digest)
