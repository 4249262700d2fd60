"""How far the sources of a language differ in their words: a table-driven tokenizer and sparse sums.

A text's bytes go through one translate table that lowers A-Z and blanks every separator; the words are
what ``split`` leaves. A task adds up the counters of its documents for each (language, source) and hands
on one row a word, so a word of every document costs one row a task. From there on only counts above
zero are kept: a word that a source lacks has one fixed probability there, whose share of every sum is
known from the number of words alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trainflow.workspace import written

#: A-Z are lowered; other ASCII bytes that are no letters become blanks; bytes beyond ASCII stay.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of a text that are split at once, and distinct words that a task holds.
BLOCK, HELD = 1 << 20, 300_000
#: Pairs that are added up at once: sums of so many differences are exact in double precision.
PAIRS = 1 << 20

CELLS = "lang string, source string, term binary, n long, docs long"


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a block at a time; blocks end between words."""
    start = 0
    while start < len(text):
        end = min(start + BLOCK, len(text))
        block = text[start:end].translate(TABLE)
        if end < len(text):
            cut = block.rfind(b" ")
            while cut < 0 and end < len(text):  # a word longer than a block
                more = text[end : end + BLOCK].translate(TABLE)
                end += len(more)
                cut = block.rfind(b" ") if (found := more.find(b" ")) < 0 else len(block) + found
                block += more
            if cut >= 0 and end < len(text):
                end, block = start + cut + 1, block[:cut]
        yield block.split()
        start = end


class _Counts:
    """Occurrences and documents of every word, by language and source."""

    def __init__(self):
        self.groups: dict[tuple, tuple[Counter, Counter]] = {}

    def add(self, lang: str, source: str, text: bytes) -> int:
        """Counts one document; returns how many different words it has."""
        total, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        own: Counter = Counter()
        for block in words(text):
            own.update(block)
            total.update(block)
        docs.update(own.keys())
        return len(own)

    def held(self) -> int:
        return sum(len(docs) for _, docs in self.groups.values())

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, docs) in self.groups.items():
            # A row without a word says that the group occurs.
            terms, n, d = [None, *docs], [0, *map(total.__getitem__, docs)], [0, *docs.values()]
            for k in range(0, len(terms), 1 << 16):
                part = slice(k, k + (1 << 16))
                size = len(terms[part])
                columns = [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    pa.array(terms[part], pa.binary()),
                    pa.array(n[part], pa.int64()),
                    pa.array(d[part], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        self.groups = {}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, since = _Counts(), 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, (lang, source) in enumerate(zip(langs, sources, strict=True)):
            since += counts.add(lang, source, batch.column(2)[i].as_py())
            if since >= HELD:  # an upper bound of the words added since they were last counted
                since = counts.held()
                if since >= HELD // 2:
                    yield from counts.rows()
                    since = 0
    yield from counts.rows()


def term_counts(docs: DataFrame, least_docs: int, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, n_lang, first``: words of at least ``least_docs`` rows of their language.

    ``n`` is the word's count in the source, ``n_lang`` in the language; ``first`` marks one row of each
    word and language. A row with a null ``term`` stands for every occurring (lang, source). Null texts,
    languages and sources are read as empty ones. Every row is a document, repeated rows too. The rows
    are dealt out once, by language and word; a word has one row for each source and task.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang, source, text)]
    rows = docs.select(filled[0].alias("lang"), filled[1].alias("source"), filled[2].cast("binary").alias("t"))
    cells = rows.mapInArrow(_counted, CELLS).repartition("lang", "term")
    cells = cells.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    word = Window.partitionBy("lang", "term")
    cells = cells.withColumns(
        {
            "df": F.sum("docs").over(word),
            "n_lang": F.sum("n").over(word),
            "first": F.row_number().over(word.orderBy("source")) == 1,
        }
    )
    kept = cells.where(F.col("term").isNull() | (F.col("df") >= least_docs))
    return kept.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "n_lang", "first")


def _share(count: Column, total: Column, size: Column, smooth: int, scale: int) -> Column:
    """1 + floor(scale * (count + smooth) / (total + smooth * size)), exactly; null if there is no word."""
    above = F.lit(scale).cast("decimal(12,0)") * (count + F.lit(smooth)).cast("decimal(20,0)")
    below = (total + F.lit(smooth) * size).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(20,0)")))


def _shared_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up, over the words of a task, what two groups that both have a word differ by beyond the
    one-sided sums. A word's groups come as one list; only sums over many words leave the task."""
    keys, sums = np.empty((0, 2), np.int64), np.empty(0, np.int64)

    def out() -> pa.RecordBatch:
        columns = [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(sums)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "x"])

    for batch in batches:
        lists = batch.column(0)
        parts = lists.flatten()
        g, p, z = (np.asarray(parts.field(i), np.int64) for i in range(3))
        sizes = np.diff(np.asarray(lists.offsets))
        behind = np.repeat(np.cumsum(sizes), sizes)  # where each element's list ends
        partners = behind - np.arange(len(g)) - 1
        bounds = np.concatenate(([0], np.cumsum(partners)))
        i = 0
        while i < len(g):
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PAIRS, "right")) - 1)
            left = np.repeat(np.arange(i, j), partners[i:j])
            right = left + 1 + np.arange(len(left)) - np.repeat(bounds[i:j] - bounds[i], partners[i:j])
            i = j
            if not len(left):
                continue
            x = np.abs(p[left] - p[right]) - np.abs(p[left] - z[right]) - np.abs(z[left] - p[right]) + np.abs(z[left] - z[right])
            both = np.concatenate((keys, np.stack((g[left], g[right]), 1)))
            values = np.concatenate((sums, x))
            order = np.lexsort((both[:, 1], both[:, 0]))
            both, values = both[order], values[order]
            new = np.flatnonzero(np.concatenate(([True], (both[1:] != both[:-1]).any(1))))
            keys, sums = both[new], np.add.reduceat(values, new)
            if len(keys) >= PAIRS:
                yield out()
                keys, sums = keys[:0], sums[:0]
    if len(keys):
        yield out()


def audit(
    docs: DataFrame,
    least_docs: int = 30,
    smooth: int = 5,
    scale: int = 1_000_000_000,
    top: int = 50,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets the sources of a language apart.

    Words are runs of letters A-Z, lowered, and of anything beyond ASCII; a language keeps those that at
    least ``least_docs`` of its documents have. With ``count`` occurrences, N over all kept words and V
    kept words, a source or language gives a word p = 1 + floor(scale * (count + smooth) / (N + smooth * V)).
    Part ``pair``: the sum over all kept words of abs(p - q) to each other source of the language, which
    is 0 if no word is kept. Part ``term``: the ``top`` words that the source has and gives more than its
    language does, by that difference. ``rank`` counts from 1 by value from the largest, then by item in
    the order of its bytes. Null texts, languages and sources are read as empty ones; every row is a
    document, also a repeated one; groups without words take part; other columns are not read. An empty
    table gives no rows. All sums are exact. A word's list of sources is held at once; the result is
    larger by itself, as it has a row for each pair of sources.
    """
    kept = written(term_counts(docs, least_docs, text, lang, source), "terms")
    real = F.col("term").isNotNull()
    sizes = kept.where(real).groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("n_all"))
    groups = kept.groupBy("lang", "source").agg(F.sum(F.when(real, F.col("n")).otherwise(0)).alias("n_group"))
    groups = groups.join(sizes, "lang", "left").na.fill(0, ["v", "n_all"])
    number = F.row_number().over(Window.orderBy("lang", "source"))  # one row for each source
    zero = _share(F.lit(0).cast("long"), F.col("n_group"), F.col("v"), smooth, scale)
    groups = written(groups.withColumns({"g": number.cast("long"), "z": zero}), "groups")

    cells = kept.where(real).join(groups, ["lang", "source"])
    cells = cells.withColumn("p", _share(F.col("n"), F.col("n_group"), F.col("v"), smooth, scale))
    q = _share(F.col("n_lang"), F.col("n_all"), F.col("v"), smooth, scale)
    terms = cells.withColumn("value", F.col("p") - q).where("value > 0").select("lang", "source", F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    here = groups.select("lang", F.col("g").alias("a"), F.col("z").alias("za"), "v")
    there = groups.select("lang", F.col("g").alias("b"), F.col("z").alias("zb"))
    apart = F.abs(F.col("za") - F.col("zb"))
    base = here.join(there, "lang").where("a <> b").select("a", "b", F.coalesce(F.col("v") * apart, F.lit(0)).alias("x"))
    # Words that the first of two groups has, as if the second lacked them all: by equal counts.
    equal = cells.groupBy("lang", F.col("g").alias("a"), F.col("z").alias("za"), "p").agg(F.count(F.lit(1)).alias("c"))
    one = equal.join(there, "lang").where("a <> b")
    one = one.groupBy("a", "b").agg(F.sum(F.col("c") * (F.abs(F.col("p") - F.col("zb")) - apart)).alias("x"))
    sources = F.sort_array(F.collect_list(F.struct("g", "p", "z")))
    two = cells.groupBy("lang", "term").agg(sources.alias("s")).where(F.size("s") > 1)
    two = two.select("s").mapInArrow(_shared_pairs, "a long, b long, x long")
    two = two.groupBy("a", "b").agg(F.sum("x").alias("x"))
    turned = [df.select(F.col("b").alias("a"), F.col("a").alias("b"), "x") for df in (one, two)]
    parts = base.unionByName(one).unionByName(two).unionByName(turned[0]).unionByName(turned[1])
    pairs = parts.groupBy("a", "b").agg(F.sum("x").alias("value"))
    pairs = pairs.join(groups.select(F.col("g").alias("a"), "lang", "source"), "a")
    pairs = pairs.join(groups.select(F.col("g").alias("b"), F.col("source").alias("item")), "b")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).select("lang", "source", "item", "value", "rank")
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
