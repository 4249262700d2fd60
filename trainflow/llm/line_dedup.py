"""Repeated and nearly repeated lines, by a segment-partition edit join in DataFrame functions alone.

Two lines within ``EDITS`` edits share, untouched, one of the ``EDITS`` + 1 segments that the shorter
one is cut into. So each line is listed under its segments, and looked up under those of its substrings
that can be such a segment of a line of its own or a slightly smaller length, at the few starts that
the edits before and after allow. Most keys occur once in all: keys are counted first, and only lines
with a key that occurs again are joined. A key that very many lines share, as the beginning of log lines
is, is parted by segments of what stands beside it, which near lines share as well. Pairs are verified
with a banded bit-parallel edit distance, and lines linked by it, directly or through others, are one
class. Copies are one line throughout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainflow.functions.names import free
from trainflow.llm.components import components
from trainflow.llm.sieve import sieved
from trainflow.workspace import written

#: Most edits between near lines, and least length in code points of a line that is compared so;
#: shorter lines have to be equal.
EDITS, LEAST_CHARS = 2, 24
LAST_KEY = (1 << 63) - 1
#: A key that more lines have is parted by what stands beside the segment, at most so many times.
HOT, PARTINGS = 1_000, 4


def _edge(number: int, less: int, segments: int) -> str:
    """Where a segment of a line shorter by ``less`` ends; segment ``number`` + 1 begins behind it."""
    return {0: "0", segments: f"(n - {less})"}.get(number, f"e{number}_{less}")


def _cut(lines: DataFrame, edits: int) -> DataFrame:
    """Adds segment ends, and for each segment the window of ``l`` that holds all its places.

    Small columns of their own: one large expression would not be compiled to machine code.
    """
    segments = edits + 1
    inner = [(j, less) for j in range(1, segments) for less in range(segments)]
    ends = {_edge(j, less, segments): F.expr(f"cast({j} * (n - {less}) div {segments} as int)") for j, less in inner}
    first = {f"s{i}": F.expr(f"greatest(1, {_edge(i - 1, edits, segments)} + 1 - {edits})") for i in range(1, segments + 1)}
    windows = {}
    for i in range(1, segments + 1):
        size = f"{_edge(i, 0, segments)} - {_edge(i - 1, 0, segments)} + {3 * edits + 3}"
        windows[f"w{i}"] = F.expr(f"substring(l, s{i}, {size})")
    return lines.withColumns(ends).withColumns(first).withColumns(windows)


def _places(edits: int) -> list[tuple[int, int, int]]:
    """Segment number, how much smaller the line that has it is, and the shift, of every key of a line; the
    first ``edits`` + 1 are the line's own segments."""
    segments, listed, others = edits + 1, [], []
    for less in range(segments):
        for i in range(1, segments + 1):
            left, right = i - 1, segments - i
            for shift in range(max(-left, less - right), min(left, less + right) + 1):
                (listed if less == shift == 0 else others).append((i, less, shift))
    return listed + others


def _keys(edits: int) -> Column:
    """The keys a line is looked up under; it is listed under the first ``edits`` + 1 as well."""
    keys = []
    for i, less, shift in _places(edits):
        start, end = _edge(i - 1, less, edits + 1), _edge(i, less, edits + 1)
        keys.append(f"xxhash64({i}, n - {less}, substring(w{i}, {start} - s{i} + {shift + 2}, {end} - {start}))")
    return F.expr(f"array({', '.join(keys)})")


def _rests(edits: int) -> Column:
    """For each key, what of the line is to the right of the segment, for the last segment what is to its left."""
    rests = []
    for i, less, shift in _places(edits):
        start, end = _edge(i - 1, less, edits + 1), _edge(i, less, edits + 1)
        rests.append(f"substring(l, 1, {start} + {shift})" if i == edits + 1 else f"substring(l, {end} + {shift + 1})")
    return F.expr(f"array({', '.join(rests)})")


def _parted(texts: DataFrame, hot: DataFrame, edits: int, least: int) -> DataFrame:
    """``h, g, key, own`` in place of the hot keys: lines within the edits that share a segment differ by no more
    in what stands beside it, so they also share a segment of that. It is taken for the key, with the hot one,
    as often as keys stay hot and enough of the line is left.
    """
    place = F.explode(F.arrays_zip(_keys(edits).alias("key"), _rests(edits).alias("l"))).alias("e")
    rows = _cut(texts, edits).select("h", "g", place).select("h", "g", "e.key", "e.l")
    rows = rows.join(hot, "key", "left_semi").withColumn("n", F.char_length("l"))
    done = []
    for _ in range(PARTINGS):
        # Rests of two lines are of nearly equal length: a short one also meets those a little longer.
        short = rows.where(F.col("n") < least + edits).select("h", "g", F.xxhash64(F.lit(0), "key").alias("key"), F.lit(True).alias("own"))
        done.append(short)
        entries = F.posexplode(F.arrays_zip(_keys(edits).alias("k"), _rests(edits).alias("r"))).alias("i", "e")
        rows = _cut(rows.where(F.col("n") >= least), edits).select("h", "g", "key", entries)
        rows = rows.select("h", "g", F.xxhash64("key", "e.k").alias("key"), (F.col("i") <= edits).alias("own"), F.col("e.r").alias("l"))
        rows = written(rows.distinct(), "parted")
        counts = rows.groupBy("key").agg(F.count_distinct("h", "g").alias("c"), F.max("own").alias("own")).where("c > 1 AND own")
        counts = written(counts.select("key", "c"), "parted-keys")
        done.append(rows.join(counts.where(F.col("c") <= HOT).select("key"), "key", "left_semi").select("h", "g", "key", "own"))
        still = counts.where(F.col("c") > HOT).select("key")
        if still.isEmpty():
            break
        rows = rows.join(still, "key", "left_semi").withColumn("n", F.char_length("l"))
    else:
        done.append(rows.select("h", "g", "key", "own"))
    return reduce(DataFrame.unionByName, done)


#: Frequent characters; an edit changes the counts of at most two of them, by one each.
COUNTED = " eatnoirshdluc"


def _bag() -> dict[str, Column]:
    """How often a line ``l`` has each counted character."""
    size = F.octet_length("l")
    return {f"c{i}": size - F.octet_length(F.replace(F.col("l"), F.lit(c), F.lit(""))) for i, c in enumerate(COUNTED)}


def near(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are within ``edits`` edits, by bit vectors over the band of their diagonals.

    Bit k of a column's vectors stands for the row ``edits`` - k before the diagonal. While the band's
    lowest row is inside the first text, the distance is followed down that edge of the band; then
    along the first text's last row. No place of a column is nearer than that edge less the band's
    height, so beyond three times the edits a pair is given up.
    """
    width = 2 * edits + 1
    mask = (1 << width) - 1
    size_a, size_b = F.char_length(a), F.char_length(b)
    swap = size_a < size_b
    longer, shorter = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b)

    def fold(rows: Column, columns: Column) -> Column:
        n = F.size(rows)

        def step(state: Column, i: Column) -> Column:
            char = F.get(columns, i)
            match = F.lit(0).cast("long")
            for k in range(width):
                same = F.coalesce(F.get(rows, i + (k - edits)) == char, F.lit(False))
                match = match.bitwiseOR(F.when(same, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
            after = F.transform(F.array(F.struct(match.alias("m"), state.alias("s"))), lambda x: _column(x, i, n))[0]
            return F.when(state["d"] > 3 * edits, state).otherwise(after)

        def _column(x: Column, i: Column, n: Column) -> Column:
            m, up, down, d = x["m"], x["s"]["up"], x["s"]["down"], x["s"]["d"]
            diagonal = (m.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseOR(m).bitwiseOR(down).bitwiseAND(mask)
            return F.transform(F.array(F.struct(diagonal.alias("q"))), lambda z: _moved(z["q"], up, down, d, i, n))[0]

        def _moved(q: Column, up: Column, down: Column, d: Column, i: Column, n: Column) -> Column:
            more = down.bitwiseOR(F.bitwise_not(q.bitwiseOR(up))).bitwiseAND(mask)
            fewer = q.bitwiseAND(up)
            later = F.shiftright(q, 1)
            place = (F.lit(width - 2) - (i - (n - edits))).cast("int")
            bit = lambda v: F.call_function("shiftright", v, place).bitwiseAND(1).cast("int")
            edge = F.lit(1) - F.shiftright(q, width - 1).bitwiseAND(1).cast("int")
            return F.struct(
                fewer.bitwiseOR(F.bitwise_not(later.bitwiseOR(more)).bitwiseAND(mask)).alias("up"),
                later.bitwiseAND(more).alias("down"),
                (d + F.when(i < n - edits, edge).otherwise(bit(more) - bit(fewer))).alias("d"),
            )

        start = F.struct(
            F.lit(mask >> edits << edits).cast("long").alias("up"),
            F.lit(0).cast("long").alias("down"),
            F.lit(edits).alias("d"),
        )
        places = F.when(F.size(columns) > 0, F.sequence(F.lit(0), F.size(columns) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, start, step, lambda s: s["d"])

    characters = F.transform(
        F.array(F.struct(F.split(longer, "").alias("a"), F.split(shorter, "").alias("b"))), lambda x: fold(x["a"], x["b"])
    )
    # A text no longer than the edits allow may have no row of the band to follow.
    small = F.greatest(size_a, size_b) <= edits
    apart = F.abs(size_a - size_b) > edits
    return F.when(small, True).when(apart, False).otherwise(characters[0] <= edits)


def _lines(own: DataFrame) -> DataFrame:
    """``d, x, at, l`` and two hashes of every line that is not blank."""
    lines = own.select("d", "x", F.posexplode(F.split("t", "\n")).alias("at", "l")).where("trim(l) <> ''")
    return lines.withColumns({"h": F.xxhash64("l"), "g": F.xxhash64(F.lit(1), F.col("l"))})


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Texts with what tells documents apart: the key and a hash of the text."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST_KEY)).alias("d"), F.xxhash64(filled).alias("x"), filled.alias("t")
    )


def line_links(lines: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """``a, b``: hashes (``h``, ``g``) of different lines of at least ``least`` characters within ``edits`` edits.

    Takes any number of rows ``l, h, g`` for each line.
    """
    long = lines.select("h", "g", "l", F.char_length("l").alias("n")).where(F.col("n") >= least)
    keyed = _cut(long, edits).select("h", "g", F.posexplode(_keys(edits)).alias("i", "key"))
    # One number: how often a key occurs, and above bit 32 how often it is a line's own.
    weight = F.when(F.col("i") <= edits, F.lit((1 << 32) + 1)).otherwise(F.lit(1).cast("long"))
    counts = keyed.groupBy("key").agg(F.sum(weight).alias("c"))
    again = written(counts.where(f"c >= {1 << 32} AND c % {1 << 32} > 1").select("key"), "keys")
    met = sieved(keyed, "key", again, "met").where("met")
    met = written(met.select("h", "g", "key", (F.col("i") <= edits).alias("own")).distinct(), "met")
    # Copies are gone; what is left are keys of different lines.
    shared = met.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max("own").alias("own")).where("c > 1 AND own")
    shared = written(shared, "shared")
    met = written(met.join(shared.select("key"), "key", "left_semi"), "segments")
    ends = written(met.select("h", "g").distinct(), "ends")
    texts = sieved(long, "h", ends.select("h"), "met").where("met").join(ends, ["h", "g"], "left_semi")
    texts = texts.groupBy("h", "g").agg(F.min("l").alias("l")).withColumn("n", F.char_length("l"))
    texts = written(texts.withColumns(_bag()), "lines")
    bag = [f"c{i}" for i in range(len(COUNTED))]
    hot = written(shared.where(F.col("c") > HOT).select("key"), "hot")
    parted = not hot.isEmpty()
    if parted:
        others = _parted(texts, hot, edits, least).groupBy("h", "g", "key").agg(F.max("own").alias("own"))
        met = met.join(hot, "key", "left_anti").withColumn("any", F.lit(False)).unionByName(others.withColumn("any", F.lit(True)))
    else:
        met = met.withColumn("any", F.lit(False))
    named = written(met.join(texts.select("h", "g", "n", *bag), ["h", "g"]), "named")
    renamed = {"h": "h2", "g": "g2", "n": "n2"} | {c: f"other_{c}" for c in bag}
    listed = named.where("own").drop("own", "any").withColumnsRenamed(renamed)
    # Of two lines of one length the one with the larger hash looks up the other; rests meet either way.
    before = "(n2 < n OR (n2 = n AND (h2 < h OR (h2 = h AND g2 < g))))"
    apart = " + ".join(f"abs({c} - other_{c})" for c in bag)
    pairs = named.join(listed, "key").where(f"(any AND (h2 <> h OR g2 <> g) OR {before}) AND {apart} <= {2 * edits}")
    if parted:
        one, two = F.struct("h", "g"), F.struct(F.col("h2").alias("h"), F.col("g2").alias("g"))
        pairs = pairs.select(F.greatest(one, two).alias("a"), F.least(one, two).alias("b")).distinct()
        pairs = pairs.select("a.h", "a.g", F.col("b.h").alias("h2"), F.col("b.g").alias("g2"))
    pairs = written(pairs.select("h", "g", "h2", "g2").distinct(), "pairs")
    texts = texts.select("h", "g", "l")
    other = texts.select(F.col("h").alias("h2"), F.col("g").alias("g2"), F.col("l").alias("l2"))
    both = pairs.join(texts, ["h", "g"]).join(other, ["h2", "g2"])
    found = both.where(near(F.col("l"), F.col("l2"), edits))
    return found.select(F.struct("h", "g").alias("a"), F.struct(F.col("h2").alias("h"), F.col("g2").alias("g")).alias("b"))


def _losses(own: DataFrame, edits: int, least: int) -> DataFrame:
    """``d, x, lost``: documents that lose lines, and which."""
    lines = _lines(own)
    place = F.struct("d", "x", "at")
    firsts = lines.groupBy("h", "g").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c"))
    firsts = written(firsts, "firsts")
    roots = components(line_links(lines, edits, least), "a", "b")
    linked = written(roots.select("node.h", "node.g", "root"), "classes")
    members = firsts.join(linked, ["h", "g"]).select("h", "g", "root", "first")
    least_of = members.groupBy("root").agg(F.min("first").alias("first"))
    near_lines = members.drop("first").join(least_of, "root").select("h", "g", "first")
    repeated = firsts.where("c > 1").join(linked, ["h", "g"], "left_anti").select("h", "g", "first")
    judged = written(near_lines.unionByName(repeated), "judged")
    spots = sieved(lines.select("d", "x", "at", "h", "g"), "h", judged.select("h"), "met").where("met")
    lost = spots.join(judged, ["h", "g"]).where(place != F.col("first"))
    return written(lost.groupBy("d", "x").agg(F.collect_set("at").alias("lost")), "lost")


def deduplicated(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    edits: int = EDITS,
    least: int = LEAST_CHARS,
    counts: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """The rows of ``docs`` without repeated lines, with the number of lines and of removed ones added.

    Lines are what stands between line feeds. Of each class of near lines (within ``edits`` edits if
    both have ``least`` characters, else equal) the first stays: in the smallest key, then the text of
    the smallest hash, then by place; the others go, also within a document. Blank lines stay. Kept
    lines are joined by line feeds. Null keys come last. A null text stays null and has no lines, an
    empty one has one blank line. Rows equal in key and text are one document and keep the same lines.
    Other columns stay as they are; columns with the names of ``counts`` are replaced. An empty table gives no rows.
    """
    lost = _losses(_identified(docs, key, text), edits, least)
    own, hashed, met, gone, parts = free([*docs.columns, *counts], "__d", "__x", "__met", "__lost", "__lines")
    d = F.coalesce(F.col(key).cast("long"), F.lit(LAST_KEY))
    x = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.withColumns({own: d, hashed: x})
    rows = sieved(rows, hashed, lost.select(F.col("x").alias(hashed)), met)
    lost = lost.select(F.col("d").alias(own), F.col("x").alias(hashed), F.col("lost").alias(gone))
    some = rows.where(F.col(met)).join(lost, [own, hashed], "left")
    none = rows.where(~F.col(met)).withColumn(gone, F.lit(None).cast("array<int>"))
    every = some.unionByName(none).withColumn(parts, F.split(text, "\n"))
    places = F.sequence(F.lit(0), F.size(parts) - 1)
    kept = F.transform(F.array_except(places, F.col(gone)), lambda i: F.get(F.col(parts), i))
    return every.withColumns(
        {
            text: F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")),
            counts[0]: F.coalesce(F.size(parts), F.lit(0)).cast("long"),
            counts[1]: F.coalesce(F.size(gone), F.lit(0)).cast("long"),
        }
    ).select(*[c for c in docs.columns if c not in counts], *counts)
