"""Quality of texts by a factorisation machine.

The inputs of a text are its hashed words (weights of length 1), structure statistics and the length
its row states. Each input i has a weight and a vector of ``RANK`` numbers; the score is the logistic
function of the bias, the weighted inputs, and all pairwise products <v_i, v_j> x_i x_j, which take
linear time as half of (sum of v_i x_i)^2 - sum of (v_i x_i)^2, for each of the ``RANK`` places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainflow.llm import words

#: Slots of hashed words, numbers per input, most labelled rows that a fit takes.
SLOTS, RANK, MOST_ROWS = 1 << 16, 8, 12_000
EPOCHS, TOGETHER, PACE = 12, 128, 0.05
#: Texts whose inputs are held at once when scoring.
FEW = 256
#: Shrinkage of weights and vectors at each step.
SHRINK = 1e-4
#: Statistics are cut off beyond so many standard deviations.
FAR = 4.0

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "beyond_ascii", "lines", "distinct_words",
    "top_word", "repeated_word", "distinct_triples", "distinct_lines", "longest_line", "blanks",
    "no_stated_length", "stated_length", "length_gap",
)

_UPPER = words.byte_class(bytes(range(0x41, 0x5B)))
_LOWER = words.byte_class(bytes(range(0x61, 0x7B)))
_DIGIT = words.byte_class(bytes(range(0x30, 0x3A)))
_BEYOND = words.byte_class(bytes(range(0x80, 0x100)))
_FIRST = ~words.byte_class(bytes(range(0x80, 0xC0)))
_BLANK = words.byte_class(b" \t\r")
_MARK = words.byte_class(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum()))
_LINE = ~words.byte_class(b"\n")


@dataclass
class Inputs:
    """Texts as rows: word slots and weights row after row, where rows begin, statistics."""

    slots: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray
    statistics: np.ndarray


def _per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return sums[edges[1:]] - sums[edges[:-1]]


def _distinct(text: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different values of each text, and how often the most frequent one occurs."""
    if not len(text):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    starts = np.flatnonzero(new)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, text[starts], np.diff(np.append(starts, len(text))))
    return np.bincount(text[starts], minlength=n), top


def _block(data: np.ndarray, at: np.ndarray, stated: np.ndarray) -> tuple:
    n = len(at) - 1
    lower = data + np.where(_UPPER[data], np.uint8(32), np.uint8(0)).astype(np.uint8)
    starts, ends = words.spans(lower, words.WORD)
    edges = np.searchsorted(starts, at)
    hashes = words.hashes(lower, starts, ends)
    text = np.repeat(np.arange(n), np.diff(edges))
    keys, counts = np.unique(text * SLOTS + (hashes % np.uint64(SLOTS)).astype(np.int64), return_counts=True)
    owner, slots = keys // SLOTS, keys % SLOTS
    weights = np.log1p(counts)
    norm = np.sqrt(np.bincount(owner, weights**2, n))
    weights /= norm[owner]

    size = np.maximum(np.diff(at) - 1, 0)
    count = np.diff(edges)
    members = {"u": _UPPER, "l": _LOWER, "d": _DIGIT, "b": _BEYOND, "m": _MARK, "s": _BLANK, "f": _FIRST}
    kinds = {k: _per_text(m[data], at) for k, m in members.items()}
    different, top = _distinct(text, hashes, n)
    same = np.zeros(len(text), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    triples = words.rolled(hashes, 3)
    inside = text[: len(triples)] == text[2:] if len(triples) else np.zeros(0, bool)
    triple_count = np.bincount(text[: len(triples)][inside], minlength=n)
    triple_kinds, _ = _distinct(text[: len(triples)][inside], triples[inside], n)
    line_start, line_end = words.spans(data, _LINE)
    cut = np.searchsorted(line_start, at)
    line_text = np.repeat(np.arange(n), np.diff(cut))
    line_kinds, _ = _distinct(line_text, words.hashes(data, line_start, line_end), n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, line_text, line_end - line_start)
    line_count = np.diff(cut)

    share = lambda a, b: a / np.maximum(b, 1)
    known = ~np.isnan(stated)
    said = np.where(known, np.maximum(stated, 0), 0)
    chars = kinds["f"] - 1  # the blank behind each text is no part of it
    statistics = np.stack(
        [
            np.log1p(size),
            np.log1p(count),
            share(_per_text(ends - starts, edges), count),
            share(kinds["u"], kinds["u"] + kinds["l"]),
            share(kinds["d"], size),
            share(kinds["m"], size),
            share(kinds["b"], size),
            np.log1p(line_count),
            share(different, count),
            share(top, count),
            share(_per_text(same, edges), count),
            share(triple_kinds, triple_count),
            share(line_kinds, line_count),
            np.log1p(longest),
            share(kinds["s"] - 1, size),
            (~known).astype(float),
            np.log1p(said),
            np.where(known, np.log1p(np.abs(said - chars)), 0),
        ],
        axis=1,
    )
    return slots, weights, np.bincount(owner, minlength=n), statistics


def inputs(texts: list[bytes | None], stated: np.ndarray) -> Inputs:
    """The inputs of texts in UTF-8, with the lengths their rows state (nan if unknown)."""
    parts = []
    for first, data, at in words.grouped(texts):
        parts.append(_block(data, at, stated[first : first + len(at) - 1]))
    if not parts:
        return Inputs(np.empty(0, np.int64), np.empty(0), np.zeros(1, np.int64), np.empty((0, len(STATISTICS))))
    slots, weights, counts, statistics = (np.concatenate(p) for p in zip(*parts, strict=True))
    return Inputs(slots, weights, np.concatenate(([0], np.cumsum(counts))), statistics)


@dataclass
class Machine:
    """Bias, weight and vector of every input (words first), centre and spread of the statistics."""

    bias: float
    weight: np.ndarray
    vector: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    def rows(self, x: Inputs, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs of the chosen rows, word after word, statistics behind: row, input, value."""
        counts = x.bounds[chosen + 1] - x.bounds[chosen]
        total = int(counts.sum())
        at = np.repeat(x.bounds[chosen] - np.cumsum(counts) + counts, counts) + np.arange(total)
        k = x.statistics.shape[1]
        scaled = np.clip((x.statistics[chosen] - self.centre) / self.spread, -FAR, FAR)
        row = np.concatenate((np.repeat(np.arange(len(chosen)), counts), np.repeat(np.arange(len(chosen)), k)))
        column = np.concatenate((x.slots[at], np.tile(SLOTS + np.arange(k), len(chosen))))
        value = np.concatenate((x.weights[at], scaled.ravel()))
        order = np.argsort(row, kind="stable")
        return row[order], column[order], value[order]

    def raw(self, row: np.ndarray, column: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score before the logistic function, and the sums of vectors; every row has inputs."""
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        parts = self.vector[column] * value[:, None]
        sums = np.add.reduceat(parts, starts)
        squares = np.add.reduceat(parts**2, starts)
        linear = np.add.reduceat(self.weight[column] * value, starts)
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums

    def score(self, x: Inputs) -> np.ndarray:
        out = np.empty(len(x.bounds) - 1)
        for k in range(0, len(out), 256):
            chosen = np.arange(k, min(k + 256, len(out)))
            out[chosen] = _logistic(self.raw(*self.rows(x, chosen))[0])
        return out


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: Inputs, labels: np.ndarray, seed: int = 7) -> Machine:
    """Learns from labelled texts by adaptive gradient steps; the same rows give the same machine.

    Without rows every score is one half.
    """
    rng = np.random.default_rng(seed)
    n, k = len(labels), len(STATISTICS)
    centre = x.statistics.mean(axis=0) if n else np.zeros(k)
    spread = np.maximum(x.statistics.std(axis=0), 1e-3) if n else np.ones(k)
    vector = rng.normal(0, 0.05, (SLOTS + k, RANK)) if n else np.zeros((SLOTS + k, RANK))
    own = Machine(0.0, np.zeros(SLOTS + k), vector, centre, spread)
    if not n:
        return own
    rate = (labels.sum() + 1) / (n + 2)
    own.bias = float(np.log(rate / (1 - rate)))
    weight_seen, vector_seen, bias_seen = np.full(SLOTS + k, 1e-2), np.full(SLOTS + k, 1e-2), 1e-2
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for first in range(0, n, TOGETHER):
            chosen = order[first : first + TOGETHER]
            row, column, value = own.rows(x, chosen)
            raw, sums = own.raw(row, column, value)
            error = (_logistic(raw) - labels[chosen]) / len(chosen)
            by = np.argsort(column, kind="stable")
            row, column, value = row[by], column[by], value[by]
            starts = np.flatnonzero(np.diff(column, prepend=-1))
            used = column[starts]
            pull = (error[row] * value)[:, None]
            slope = np.add.reduceat(pull * (sums[row] - own.vector[column] * value[:, None]), starts)
            slope += SHRINK * own.vector[used]
            flat = np.add.reduceat(pull[:, 0], starts) + SHRINK * own.weight[used]
            weight_seen[used] += flat**2
            vector_seen[used] += (slope**2).mean(axis=1)
            bias_seen += error.sum() ** 2
            own.weight[used] -= PACE * flat / np.sqrt(weight_seen[used])
            own.vector[used] -= PACE * slope / np.sqrt(vector_seen[used])[:, None]
            own.bias -= PACE * error.sum() / bias_seen**0.5
    return own


def held_out(key: Column) -> Column:
    """Rows that no fit may see: the checksum of the key as text leaves 1 when divided by 3."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text",
    length: str = "n_chars", most: int = MOST_ROWS,
) -> Machine:
    """Fits a machine on at most ``most`` labelled keys that are not held out, drawn by a digest of the key.

    A key labelled more than once has the label of most of its rows (1 if even); null keys and labels are left out.
    """
    named = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
    named = named.groupBy(F.col(key).alias("__key")).agg((F.avg(label) >= 0.5).cast("double").alias("__label"))
    drawn = F.broadcast(named.orderBy(F.xxhash64("__key"), "__key").limit(most))
    stated = F.col(length).cast("double").alias("__n")
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("binary").alias("__t"), stated)
    rows = rows.join(drawn, "__key").select("__key", "__t", "__n", "__label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stated = batch.column(2).cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
            x = inputs(batch.column(1).to_pylist(), stated)
            bounds = pa.array(x.bounds.astype(np.int32))
            width = pa.array(np.arange(len(x.statistics) + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.string()),
                    batch.column(3),
                    pa.ListArray.from_arrays(bounds, pa.array(x.slots.astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(x.weights)),
                    pa.ListArray.from_arrays(width, pa.array(x.statistics.ravel())),
                ],
                names=["key", "label", "slots", "weights", "statistics"],
            )

    schema = "key string, label double, slots array<int>, weights array<double>, statistics array<double>"
    # Bounded: as many rows as were drawn.
    sample = rows.mapInArrow(run, schema).toArrow().sort_by([("key", "ascending"), ("label", "ascending")])
    slots, weights, statistics = (sample[c].combine_chunks() for c in ("slots", "weights", "statistics"))
    x = Inputs(
        slots.flatten().to_numpy().astype(np.int64),
        weights.flatten().to_numpy(),
        np.concatenate(([0], np.cumsum(slots.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64),
        statistics.flatten().to_numpy().reshape(-1, len(STATISTICS)),
    )
    labelled = sample["label"].to_numpy()
    del sample, slots, weights, statistics
    machine = fit(x, labelled)
    del x
    pa.default_memory_pool().release_unused()  # the driver has other things to hold
    return machine


def scored(
    docs: DataFrame, machine: Machine, text: str = "text", length: str = "n_chars", name: str = "score"
) -> DataFrame:
    """Adds the score, from 0 to 1, of every row; all rows and columns stay.

    Null and empty texts have no words and zero statistics, and are scored on those.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts: pd.Series, stated: pd.Series) -> pd.Series:
        lengths, scores = stated.to_numpy(float, na_value=np.nan), [np.empty(0)]
        for k in range(0, len(texts), FEW):
            scores.append(shared.value.score(inputs(list(texts[k : k + FEW]), lengths[k : k + FEW])))
        return pd.Series(np.concatenate(scores))

    return docs.withColumn(name, score(F.col(text).cast("binary"), F.col(length).cast("double")))
