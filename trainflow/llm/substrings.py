"""Passages that an earlier document has as well, found with difference-cover anchors.

A cover is a set of places modulo a period such that any two places have a common offset below the
period that brings both into the cover. So two occurrences of a window of ``WINDOW`` words have an
aligned place in the cover, and share the hash of the ``ANCHOR`` words that start there. Only hashes
at cover places (a fifth of all words) are dealt out. Windows around shared anchors are then hashed
whole, in 128 bits, and held against the smallest document that has them; each such hit removes its
words, so hits grow to the whole shared passage.

Exact copies are one text from the start: a copy of a smaller document loses all words if it has a
window at all. What many documents share is combined before it is dealt out: a batch that sees an
anchor in several texts, or a window in several documents, sends one row for it and passes the
others on as found. Groups are read as sorted runs, so no group is ever held in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainflow.llm import words
from trainflow.llm.sieve import sieved
from trainflow.workspace import written

WINDOW = 50
#: A perfect difference set, every difference modulo the period occurs once.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
ANCHOR = WINDOW - PERIOD + 1

LAST = (1 << 63) - 1
#: Rows by key: an anchor's hash with the text that has it, a window's hash (96 bits) with its document
#: and text. ``p`` is the place; rows known to be hits have -1 minus their place.
ANCHORS = "x long, p int, u long"
WINDOWS = "x long, y int, p int, u long, o long"


def _text_words(texts: list[bytes | None], double: bool = False) -> Iterator[tuple]:
    """For each block: number of its first text, edges of its texts in words, the words' hashes."""
    for first, data, at in words.grouped(texts):
        starts, ends = words.spans(data, words.NOT_SPACE)
        edges = np.searchsorted(starts, at)
        yield first, edges, [words.hashes(data, starts, ends, b) for b in words.BASES[: 1 + double]]


def _rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` values, from sums of powers."""
    up, down = words.powers(words.BASES[1], len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return words.mixed((sums[width:] - sums[:-width]) * down[: len(sums) - width])


def _combined(key: list, place, unit, order, decided: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list:
    """Rows by key; keys that decide themselves in the batch send one row, the others are known."""
    by = np.lexsort((place, unit, order, *key[::-1]))
    key, place, unit, order = [k[by] for k in key], place[by], unit[by], order[by]
    new = _turns(key)
    known = decided(new, order)
    # A row known already needs no partner; the first row of each key still tells others of it.
    sent = ~known | new
    place = np.concatenate((place[sent], -1 - place[known])).astype(np.int32)
    return [*(np.concatenate((v[sent], v[known])) for v in key), place] + [
        np.concatenate((v[sent], v[known])) for v in (unit, order)
    ]


def _turns(key: list) -> np.ndarray:
    """Where a row's key differs from the one before."""
    new = np.ones(len(key[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
    return new


def _run_values(new: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The first value of each row's run."""
    return values[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]


def _shared(new: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rows of keys with several values of ``order``."""
    if not len(new):
        return new
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(new)) - 1
    return np.repeat(order[starts] != order[ends], ends - starts + 1)


def _later(new: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rows beyond the smallest value of their key."""
    return order > _run_values(new, order) if len(new) else new


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        own = batch.column(0).to_pylist()
        fresh = []
        for u in own:
            fresh.append(u not in seen)
            seen.add(u)
        keep = np.flatnonzero(fresh)
        texts, units = batch.column(1).take(pa.array(keep)).to_pylist(), np.array(own, np.int64)[keep]
        parts = []
        for first, edges, (hashes,) in _text_words(texts):
            if len(hashes) < WINDOW:
                continue
            rolled = _rolling(hashes, ANCHOR)
            text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[: len(rolled)]
            place = np.arange(len(rolled)) - edges[text]
            size = np.diff(edges)[text]
            chosen = np.isin(place % PERIOD, COVER) & (place + ANCHOR <= size) & (size >= WINDOW)
            parts.append((rolled[chosen], units[first + text[chosen]], place[chosen]))
        if parts:
            x, u, p = (np.concatenate(c) for c in zip(*parts, strict=True))
            x, p, u, _ = _combined([x], p, u, u, _shared)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(p), pa.array(u)], names=["x", "p", "u"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = batch.column(0).to_numpy(zero_copy_only=False)
        docs = batch.column(1).to_numpy(zero_copy_only=False)
        places = batch.column(3).to_pylist()
        parts = []
        for first, edges, (one, two) in _text_words(batch.column(2).to_pylist(), double=True):
            if len(one) < WINDOW:
                continue
            near = np.zeros(len(one) + 1, np.int64)
            for t in range(len(edges) - 1):
                last = edges[t + 1] - WINDOW
                if last >= edges[t]:
                    at = np.array(places[first + t], np.int64) + edges[t]
                    np.add.at(near, np.minimum(np.maximum(at - PERIOD + 1, edges[t]), last + 1), 1)
                    np.add.at(near, np.minimum(at, last) + 1, -1)
            chosen = np.flatnonzero(np.cumsum(near)[: len(one) - WINDOW + 1] > 0)
            text = np.searchsorted(edges, chosen, "right") - 1
            parts.append(
                (
                    _rolling(one, WINDOW)[chosen],
                    _rolling(two, WINDOW)[chosen] >> np.uint64(32),
                    docs[first + text],
                    units[first + text],
                    chosen - edges[text],
                )
            )
        if parts:
            x, y, o, u, p = (np.concatenate(c) for c in zip(*parts, strict=True))
            x, y, p, u, o = _combined([x, y], p, u, o, _later)
            columns = [x.view(np.int64), y.astype(np.uint32).view(np.int32), p, u, o]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["x", "y", "p", "u", "o"])


def _runs(keys: int, order: int, whole_run: bool) -> Callable:
    """Reads sorted runs of the first ``keys`` columns; passes on rows known or decided by their run.

    Rows beyond the first value of the ``order`` column are decided, with ``whole_run`` all rows of a
    run that has several values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first, held = None, 0, []  # the run that goes on: its key, first value, undecided rows
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            known = columns[keys] < 0
            out = [(columns[keys + 1][known], -1 - columns[keys][known])]
            columns = [c[~known] for c in columns]
            key, p, u, o = columns[:keys], columns[keys], columns[keys + 1], columns[order]
            if len(p):
                new = _turns(key)
                starts = np.flatnonzero(new)
                ends = np.append(starts[1:], len(new)) - 1
                goes_on = last == [k[0] for k in key]
                firsts = _run_values(new, o)
                if goes_on:
                    firsts[: ends[0] + 1] = first
                decided = o > firsts
                if whole_run:
                    several = decided[ends]
                    if goes_on and several[0]:
                        out += held
                    if several[0] or not goes_on or len(starts) > 1:
                        held = []
                    if not several[-1]:  # the run may go on: its rows are of one text so far
                        held.append((u[starts[-1] :], p[starts[-1] :]))
                    decided = np.repeat(several, ends - starts + 1)
                out.append((u[decided], p[decided]))
                last, first = [k[-1] for k in key], firsts[-1]
            both = [np.concatenate([v[i] for v in out]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1].astype(np.int32))], names=["u", "p"])

    return run


def _decided(rows: DataFrame, sort: list[str], run: Callable) -> DataFrame:
    """``u`` and the places ``p`` of rows decided by the rows of their key; known rows go anywhere."""
    dealt = rows.repartition(F.when(F.col("p") < 0, F.xxhash64("u", "p")).otherwise(F.col("x")))
    found = dealt.sortWithinPartitions(F.col("p") < 0, *sort).mapInArrow(run, "u long, p int")
    return found.groupBy("u").agg(F.collect_set("p").alias("p"))


def _left(text: bytes, places: list[int] | None, copy: bool) -> tuple[int, int, bytes]:
    """Words, words removed, and the kept ones joined by a blank."""
    own = text.split()
    if copy and len(own) >= WINDOW:
        return len(own), len(own), b""
    if not places:
        return len(own), 0, b" ".join(own)
    turns = np.zeros(len(own) + 1, np.int64)
    at = np.array(places, np.int64)
    np.add.at(turns, at, 1)
    np.add.at(turns, at + WINDOW, -1)
    kept = np.cumsum(turns)[:-1] == 0
    return len(own), int(len(own) - kept.sum()), b" ".join([w for w, k in zip(own, kept.tolist(), strict=True) if k])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, places, copies = (batch.column(i).to_pylist() for i in (1, 2, 3))
        rows = [_left(t or b"", p, bool(c)) for t, p, c in zip(texts, places, copies, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.binary()).cast(pa.string()),
            ],
            names=["k", "n_words", "n_removed", "kept"],
        )


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key (a long), ``n_words``, ``n_removed`` and ``kept``.

    ``kept`` is the text's words, joined by one blank, without those inside a window of ``WINDOW``
    words that also starts in a document with a smaller key; windows are judged on the texts as they
    come. Words are runs between white space (space, tab to carriage return). Null and empty texts
    have no words. Rows with the same key are the same document: none is smaller. A null key counts
    as larger than all others. Repeated rows come back repeated; other columns are not carried; an
    empty table gives no rows.
    """
    one, two = F.xxhash64("t"), F.xxhash64(F.lit(1), F.col("t"))
    own = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    own = own.withColumns({"d": F.coalesce("k", F.lit(LAST)), "u": one, "v": two, "t": F.col("t").cast("binary")})
    texts = own.groupBy("u", "v").agg(F.min("d").alias("m"))
    anchors = own.select("u", "t").mapInArrow(_anchors, ANCHORS)
    spots = _decided(anchors, ["x", "u"], _runs(1, 2, whole_run=True))
    # Copies have other keys than the first of their text, so they are spread and left out at once.
    first = written(texts.join(spots, "u").select("u", "v", F.col("m").alias("d"), "p"), "spots")
    near = sieved(own, "u", first.select("u"), "near").where("near").join(first, ["u", "v", "d"])
    windows = near.select("u", "d", "t", "p").mapInArrow(_windows, WINDOWS)
    hits = _decided(windows, ["x", "y", "o"], _runs(2, 4, whole_run=False))
    judged = own.select("d", "u", "v").distinct().join(texts, ["u", "v"])
    copies = judged.where("d > m").select("u", "v", "d", F.lit(None).cast("array<int>").alias("p"), F.lit(True).alias("c"))
    firsts = texts.join(hits, "u").select("u", "v", F.col("m").alias("d"), "p", F.lit(False).alias("c"))
    losing = written(copies.unionByName(firsts), "hits")
    # Texts that surely lose nothing are not dealt out.
    marked = sieved(own, "u", losing.select("u"), "near")
    plain = marked.where("NOT near").select("k", "t", F.lit(None).cast("array<int>").alias("p"), F.lit(False).alias("c"))
    some = marked.where("near").join(losing, ["u", "v", "d"], "left").select("k", "t", "p", "c")
    rows = some.unionByName(plain).mapInArrow(_kept, "k long, n_words long, n_removed long, kept string")
    return rows.withColumnRenamed("k", key)
