"""Near-duplicate documents by SimHash; links are found with sharded vantage-point trees.

A fingerprint has 64 bits. If two differ in at most ``max_bits``, then one of their 32-bit halves
differs in at most ``max_bits // 2``. So each half gets a vantage-point tree: a node keeps a vantage
point and a radius, fingerprints within the radius go left, the others right. Those on the right that
lie at most ``max_bits // 2`` beyond the radius go left as well: by the triangle inequality no other
one can be near a fingerprint on the left. Leaves are shards; each shard is searched by a tree of its
own, and candidates are checked on all 64 bits. The upper tree is built from a bounded sample; every
fingerprint is routed through it, so links are exact whatever the sample was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainflow.functions.names import free
from trainflow.llm.components import components
from trainflow.llm.sieve import sieved
from trainflow.operators.lookup import lookup
from trainflow.workspace import written

#: Fixed values of the fingerprint: seed of the shingle hash, bits.
SEED = 42
BITS = 64
#: Rows of unpacked bits held at once.
BLOCK = 1 << 15
#: The upper tree: most sampled fingerprints, fingerprints for each sampled one, sampled ones in a leaf.
MOST_SAMPLED, LEAST_SAMPLED, SAMPLED_OF, LEAF = 1 << 18, 1 << 10, 125, 16
#: A shard expected to hold more is searched as pairs of blocks of this size.
SHARD_ROWS = 200_000
#: Inside a shard: groups up to this size are compared directly.
DIRECT = 256


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The SimHash of one text in UTF-8 as a signed 64-bit number; no words give 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        parts = [line]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        parts = (line[a:b] for a, b in spans)
    digest, hashes = xxhash.xxh64_digest, b"".join
    raw = np.frombuffer(hashes([digest(p, SEED) for p in parts]), np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(raw), BLOCK):
        ones += np.unpackbits(raw[k : k + BLOCK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(raw)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """Adds the fingerprint of a text column as a long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return docs.withColumn(name, of(F.col(text).cast("binary")))


def _half(fingerprints: np.ndarray, tree: int) -> np.ndarray:
    return (fingerprints >> np.uint64(32 * tree)).astype(np.uint32)


class VantageTree:
    """Nodes as arrays: vantage point, radius, children (a leaf is -1 minus its number)."""

    def __init__(self, halves: np.ndarray, leaf: int, reach: int) -> None:
        self.reach = reach
        self.vantage, self.radius, self.children = [], [], []
        self.leaves = 0
        self.root = self._grow(halves, leaf)
        self.vantage = np.array(self.vantage, np.uint32)
        self.radius = np.array(self.radius, np.int64)
        self.children = np.array(self.children, np.int64).reshape(-1, 2)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, halves: np.ndarray, leaf: int) -> int:
        if len(halves) <= leaf:
            return self._leaf()
        far = np.bitwise_count(halves ^ halves[0]).astype(np.int64)
        radius = int(np.median(far))
        near, beyond = halves[far <= radius + self.reach], halves[far > radius]
        if len(near) == len(halves) or not len(beyond):
            return self._leaf()
        node = len(self.vantage)
        self.vantage.append(halves[0])
        self.radius.append(radius)
        self.children.append([0, 0])
        # The next vantage points come from other places of the sample.
        self.children[node] = [self._grow(np.roll(x, -(len(x) // 2)), leaf) for x in (near, beyond)]
        return node

    def route(self, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and the leaves they reach, boundary rows more than one."""
        rows, nodes = np.arange(len(halves)), np.full(len(halves), self.root)
        out = [(rows[:0], nodes[:0])]
        while len(rows):
            done = nodes < 0
            out.append((rows[done], -1 - nodes[done]))
            rows, nodes = rows[~done], nodes[~done]
            far = np.bitwise_count(halves[rows] ^ self.vantage[nodes]).astype(np.int64)
            left, right = far <= self.radius[nodes] + self.reach, far > self.radius[nodes]
            rows, nodes = (
                np.concatenate((rows[left], rows[right])),
                np.concatenate((self.children[nodes[left], 0], self.children[nodes[right], 1])),
            )
        return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


class _Forest:
    """Keeps only links that join two groups: a spanning forest of what a shard finds."""

    def __init__(self, size: int) -> None:
        self.up = np.arange(size)
        self.links: list[tuple[int, int]] = []

    def _root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def add(self, one: int, others: np.ndarray) -> None:
        roots = others
        while (above := self.up[roots]).tolist() != roots.tolist():
            roots = above
        mine = self._root(one)
        for root, place in zip(*np.unique(roots, return_index=True), strict=True):
            if root != mine:
                self.links.append((one, int(others[place])))
                low, high = min(mine, int(root)), max(mine, int(root))
                self.up[high] = mine = low


def shard_links(fingerprints: np.ndarray, tree: int, max_bits: int) -> np.ndarray:
    """Pairs that connect all fingerprints of a shard within ``max_bits`` whose halves are near."""
    reach, halves = max_bits // 2, _half(fingerprints, tree)
    forest = _Forest(len(fingerprints))
    todo = [np.arange(len(fingerprints))]
    while todo:
        rows = todo.pop()
        split = None
        if len(rows) > DIRECT:
            own = halves[rows]
            far = np.bitwise_count(own ^ own[len(own) // 2]).astype(np.int64)
            radius = int(np.median(far))
            near, beyond = rows[far <= radius + reach], rows[far > radius]
            split = len(near) < 0.9 * len(rows) and len(beyond)
        if split:
            todo += [near, beyond]
            continue
        for k in range(0, len(rows), DIRECT):
            part = rows[k : k + DIRECT]
            for j in range(k, len(rows), 1 << 14):
                other = rows[j : j + (1 << 14)]
                hit = np.bitwise_count(fingerprints[part][:, None] ^ fingerprints[other]) <= max_bits
                hit &= np.arange(j, j + len(other)) > np.arange(k, k + len(part))[:, None]
                for i in np.flatnonzero(hit.any(axis=1)):
                    forest.add(int(part[i]), other[hit[i]])
    return np.array(forest.links, np.int64).reshape(-1, 2)


def links(fingerprints: DataFrame, column: str = "fingerprint", max_bits: int = 3) -> DataFrame:
    """``a, b``: links that connect all different fingerprints at ``max_bits`` or fewer.

    Takes distinct longs without nulls. Links implied by others of a shard are left out; every two
    fingerprints within ``max_bits`` are connected through those returned.
    """
    spark = fingerprints.sparkSession
    values = fingerprints.select(F.col(column).alias("f"))
    total = values.count()
    sampled = min(MOST_SAMPLED, max(LEAST_SAMPLED, total // SAMPLED_OF))
    sample = values.orderBy(F.xxhash64("f"), "f").limit(sampled).toPandas()["f"].to_numpy(np.int64).view(np.uint64)
    trees, blocks = [], []
    for t in (0, 1):
        tree = VantageTree(_half(sample, t), LEAF, max_bits // 2)
        _, leaf = tree.route(_half(sample, t))
        expected = np.bincount(leaf, minlength=tree.leaves) * (total / max(1, len(sample)))
        trees.append(tree)
        blocks.append(np.maximum(1, np.ceil(expected / SHARD_ROWS)).astype(np.int64))
    plan = spark.sparkContext.broadcast((trees, blocks))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, blocks = plan.value
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for t, tree in enumerate(trees):
                rows, leaf = tree.route(_half(own.view(np.uint64), t))
                parts = blocks[t][leaf]
                home = (own[rows].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                home %= parts
                # A row of block h meets every block of its shard: it goes to all pairs (h, other).
                again = np.repeat(np.arange(len(rows)), parts)
                other = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
                low, high = np.minimum(home[again], other), np.maximum(home[again], other)
                cell = low * parts[again] + high
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(again), t, np.int32)),
                        pa.array(leaf[again].astype(np.int64)),
                        pa.array(cell.astype(np.int64)),
                        pa.array(own[rows][again]),
                    ],
                    names=["tree", "leaf", "cell", "f"],
                )

    def searched(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        own = shard["f"].to_numpy(np.int64)
        found = shard_links(own.view(np.uint64), int(key[0]), max_bits)
        return pd.DataFrame({"a": own[found[:, 0]], "b": own[found[:, 1]]})

    shards = values.mapInArrow(routed, "tree int, leaf long, cell long, f long")
    return shards.groupBy("tree", "leaf", "cell").applyInPandas(searched, "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row per row of ``docs``: the key, ``fingerprint`` (long) and ``component_id``.

    ``component_id`` is the smallest key in the component of fingerprints linked at ``max_bits`` or
    fewer differing bits, directly or through others. Texts without words (also null and empty ones)
    have fingerprint 0 and are linked like any other. Copies are one fingerprint before anything is
    compared. Null keys never become a ``component_id`` unless all keys of a component are null.
    Repeated rows come back repeated; other columns are not carried; an empty table gives no rows.
    """
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    rows = written(with_fingerprint(own, "t", "f", shingle).select("k", "f"), "fingerprints")
    classes = written(rows.groupBy("f").agg(F.min("k").alias("first")), "classes")
    roots = components(links(classes, "f", max_bits), "a", "b")
    members = classes.join(roots, classes["f"] == roots["node"]).select("f", "root", "first")
    smallest = members.groupBy("root").agg(F.min("first").alias("least"))
    placed = members.join(smallest, "root").select(F.col("f").alias("g"), "least")
    groups = classes.join(placed, F.col("f") == F.col("g"), "left")
    least = F.when(F.col("g").isNull(), F.col("first")).otherwise(F.col("least"))
    groups = groups.select(F.col("f").alias("g"), least.alias("c"))
    # A fingerprint may be that of a third of all rows; the lookup spreads hot ones.
    found = lookup(rows, F.col("f"), written(groups, "groups"), "g", {"c": "component_id"}, how="inner")
    return found.select(F.col("k").alias(key), F.col("f").alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row of each component, all columns: that of the smallest key, then of the smallest text hash.

    Null keys come last. Of rows equal in key and text any one stays. Only rows that may go are dealt out.
    """
    d = F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1))
    x = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    named = docs.select(F.struct(d.alias("d"), x.alias("x")).alias("k"), F.col(text).alias("t"))
    found = near_duplicates(named, "k", "t", shingle, max_bits)
    counted = found.groupBy("k").agg(F.min("component_id").alias("c"), F.count(F.lit(1)).alias("n"))
    doubtful = counted.where((F.col("k") != F.col("c")) | (F.col("n") > 1))
    doubtful = written(doubtful.select("k.d", "k.x", (F.col("k") == F.col("c")).alias("stays")), "doubtful")
    own, hashed, met, row = free(docs.columns, "__d", "__x", "__met", "__row")
    rows = docs.withColumns({own: d, hashed: x})
    rows = sieved(rows, hashed, doubtful.select(F.col("x").alias(hashed)), met)
    gone = doubtful.where("NOT stays").select(F.col("d").alias(own), F.col("x").alias(hashed))
    kept = rows.where(F.col(met)).join(gone, [own, hashed], "left_anti")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    kept = kept.groupBy(own, hashed).agg(F.first(whole).alias(row)).select(f"{row}.*")
    return rows.where(~F.col(met)).select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(kept)
