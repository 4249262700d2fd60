"""Nearest vectors by largest inner product, over an inverted multi-index.

Both halves of a vector are quantised by centroids of their own; a pair of centroids is a cell. Cells
next to one another are dealt out as shards of bounded size, a cell that is larger by itself as several.
A query first searches the shard of its most promising cell, which tells how near its k-th neighbour is
at least, then all shards with a cell that may still hold a nearer one. Within a shard it takes the pairs
of centroids from a heap, by the sum of both halves' products, and scores the cells' entries on the
original vectors, until no pair left is likely to hold a better one.

What a cell may hold is judged by its centroids' product with the query and by a margin in standard
deviations of what its entries' remainders add to it. The margin is such that, were remainders normal,
a stated share of ``k`` rows in the whole table lie beyond it. So there is no fixed number of candidates:
tight clusters are left after few cells, and vectors without any structure make a query visit a large
part of the table, more than half of it at 50 000 rows and 64 components.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import isqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trainflow.workspace import written

#: The centroids are fitted on so many rows, the least by a hash of the key, or fewer that make so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 1 << 13, 1 << 23
#: Rows of a cell on average, and most centroids of a half.
CELL_ROWS, MOST_CENTROIDS = 32, 256
#: Bytes of vectors in a shard, and queries that search it at once.
SHARD_BYTES, QUERY_ROWS = 1 << 23, 1 << 10
#: Entries scored at once.
STEP = 1024
#: Share of the ``k`` rows that may be lost to the margin; of those beyond it most are met all the same.
LOST = 0.2
ROUNDS = 12

FOUND = "q long, id long, score double"


@dataclass(frozen=True)
class Quantiser:
    """Centroids of both halves, and the mean square of a remainder's component in each of their cells,
    large remainders weighted by their size."""

    centroids: tuple[np.ndarray, np.ndarray]
    spread: tuple[np.ndarray, np.ndarray]

    @property
    def size(self) -> int:
        return len(self.centroids[0])

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.centroids[0].shape[1]
        return x[..., :cut], x[..., cut:]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The cell of each vector: first centroid times the number of centroids, plus the second."""
        first, second = (closest(half, c) for half, c in zip(self.halves(x), self.centroids, strict=True))
        return first * self.size + second

    def products(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.halves(q)
        return self.centroids[0] @ a, self.centroids[1] @ b

    def deviations(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Variances of what remainders add to the products; those of a cell's halves add up."""
        a, b = self.halves(q)
        return self.spread[0] * (a @ a), self.spread[1] * (b @ b)


def closest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row; ties to the first."""
    out = np.empty(len(x), np.int64)
    half = (centroids * centroids).sum(1) / 2
    for k in range(0, len(x), 1 << 12):
        out[k : k + (1 << 12)] = np.argmax(x[k : k + (1 << 12)] @ centroids.T - half, 1)
    return out


def fit(sample: np.ndarray, size: int) -> Quantiser:
    """K-means of both halves, from sample rows drawn with a fixed seed."""
    cut = (sample.shape[1] + 1) // 2
    centroids, spread = [], []
    for half in (sample[:, :cut], sample[:, cut:]):
        own = half[np.random.default_rng(7).permutation(len(half))[:size]].copy()
        for _ in range(ROUNDS):
            at = closest(half, own)
            counts = np.bincount(at, minlength=len(own))
            sums = np.zeros_like(own)
            np.add.at(sums, at, half)
            own[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        at = closest(half, own)
        square = ((half - own[at]) ** 2).mean(1) if half.shape[1] else np.zeros(len(half))
        # Large remainders count by their size, as the best products are among them; a centroid with few
        # sample rows leans on the mean of all.
        top = float(square.max()) or 1.0
        part, size_of = square / top, partial(np.bincount, at, minlength=len(own))
        every = (part * part).sum() / max(part.sum(), 1e-300)
        few = 4 * part.mean()
        spread.append(top * (size_of(part * part) + few * every) / np.maximum(size_of(part) + few, 1e-300))
        centroids.append(own)
    return Quantiser(tuple(centroids), tuple(spread))


@dataclass(frozen=True)
class Layout:
    """Which shards hold a cell: ``parts`` from ``first`` on. Cells without rows have no part."""

    first: np.ndarray
    parts: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, most: int) -> Layout:
        first, parts = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
        shard, held = 0, 0
        for cell in np.flatnonzero(counts):
            n = int(counts[cell])
            if held and held + n > most:
                shard, held = shard + 1, 0
            first[cell], parts[cell] = shard, -(-n // most)
            if n > most:
                shard += int(parts[cell])
            else:
                held += n
        return Layout(first, parts)


def vectors(column) -> np.ndarray:
    """An Arrow list column without nulls as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat, np.float64).reshape(len(column), -1)


def routes(q: np.ndarray, quantiser: Quantiser, layout: Layout, filled: np.ndarray, nearest: float | None, draw: int, margin: float):
    """The shard of the query's best cell; with ``nearest``, a product that its k-th neighbour has at
    least, all other shards that may hold a larger one."""
    (a, b), (va, vb) = quantiser.products(q), quantiser.deviations(q)
    i, j = np.divmod(filled, quantiser.size)
    guess = a[i] + b[j]
    best = filled[np.argmax(guess)]
    home = layout.first[best] + draw % layout.parts[best]
    if nearest is None:
        return np.array([home])
    cells = filled[guess + margin * np.sqrt(va[i] + vb[j]) >= nearest]
    shards = [layout.first[cells], *(np.arange(layout.first[c], layout.first[c] + layout.parts[c]) for c in cells[layout.parts[cells] > 1])]
    found = np.unique(np.concatenate(shards))
    return found[found != home]


class Shard:
    """The rows of a shard, sorted by cell."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, cells: np.ndarray, quantiser: Quantiser, margin: float):
        order = np.lexsort((ids, cells))
        self.ids, self.x, self.quantiser, self.margin = ids[order], x[order], quantiser, margin
        own, starts = np.unique(cells[order], return_index=True)
        bounds = np.append(starts, len(ids))
        self.members = [np.arange(*x) for x in zip(bounds, bounds[1:], strict=False)]
        # Scaled to norms of at most 1, single precision tells most rows that are not near enough.
        self.scale = float(np.abs(self.x).max()) * x.shape[1] ** 0.5
        self.rough = (self.x / self.scale).astype(np.float32)
        self.slack = (x.shape[1] + 4) * 2.0**-23
        self.repeated = len(np.unique(ids)) < len(ids)
        i, j = np.divmod(own, quantiser.size)
        self.rows, self.columns = np.unique(i), np.unique(j)
        self.grid = np.full((len(self.rows), len(self.columns)), -1)
        self.grid[np.searchsorted(self.rows, i), np.searchsorted(self.columns, j)] = np.arange(len(own))

    def pairs(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Pairs of centroids by the sum of their products, largest first."""
        order_a, order_b = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        left, right = a[order_a].tolist(), b[order_b].tolist()
        order_a, order_b = order_a.tolist(), order_b.tolist()
        heap = [(-(left[0] + right[0]), 0, 0)]
        while heap:
            guess, i, j = heapq.heappop(heap)
            yield -guess, order_a[i], order_b[j]
            if j + 1 < len(right):
                heapq.heappush(heap, (-(left[i] + right[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(left):
                heapq.heappush(heap, (-(left[i + 1] + right[0]), i + 1, 0))

    def search(self, own: int, q: np.ndarray, k: int, nearest: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and products of the best ``k`` rows found, of those not below ``nearest``; not the id ``own``."""
        (a, b), (va, vb) = self.quantiser.products(q), self.quantiser.deviations(q)
        a, b, va, vb = a[self.rows], b[self.columns], va[self.rows], vb[self.columns]
        most = self.margin * float(np.sqrt(va.max() + vb.max()))
        scale = float(np.abs(q).max()) * len(q) ** 0.5
        rough = (q / scale).astype(np.float32)
        ids, scores = np.empty(0, np.int64), np.empty(0)
        waiting, size = [], 0

        def scored() -> None:
            nonlocal ids, scores, waiting, size, nearest
            at = np.concatenate(waiting)
            waiting, size = [], 0
            at = at[~(self.rough[at] @ rough < nearest / self.scale / scale - self.slack)]
            products = (self.x[at] * q).sum(1)  # equal vectors have equal sums
            good = (products >= nearest) & (self.ids[at] != own)
            ids, scores = np.concatenate((ids, self.ids[at[good]])), np.concatenate((scores, products[good]))
            order = np.lexsort((ids, -scores))
            if self.repeated:
                order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
            ids, scores = ids[order[:k]], scores[order[:k]]
            if len(ids) == k:
                nearest = max(nearest, float(scores[-1]))

        for guess, i, j in self.pairs(a, b):
            if guess + most < nearest:
                break
            cell = self.grid[i, j]
            if cell < 0 or guess + self.margin * (va[i] + vb[j]) ** 0.5 < nearest:
                continue
            waiting.append(self.members[cell])
            size += len(waiting[-1])
            if size >= STEP:
                scored()
        if waiting:
            scored()
        return ids, scores


def _valid(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` of the rows that take part; single precision stays single."""
    kind = rows.schema[vector].dataType.simpleString()
    v = F.col(vector) if kind == "array<float>" else F.col(vector).cast("array<double>")
    own = rows.select(F.col(key).cast("long").alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return own.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def nearest(
    rows: DataFrame, asked: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", lost: float = LOST
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that meets ``asked`` (a condition on ``id``), the
    ``k`` rows found with the largest inner product, nearest first, ties to the smaller key.

    All other rows are candidates; with fewer than ``k`` all are returned. ``score`` is the product of the
    original vectors in double precision. Null keys, and vectors that are null, zero, or hold a null or a
    component that is not finite, take no part; nor do vectors of another length than most have (the
    smaller of lengths that as many have). A key with several rows counts once, with its nearest vector;
    as a query, with its least. Other columns are not read. An empty table gives no rows.

    Every row is indexed; what is fitted on a bounded sample are the centroids alone.
    """
    spark = rows.sparkSession
    own = _valid(rows, key, vector)
    widths = own.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    result = "q long, rank int, id long, score double"
    names = {"q": "query_id", "id": "vec_id"}
    if widths is None:
        return spark.createDataFrame([], result).withColumnsRenamed(names)
    width, total = widths["d"], widths["n"]
    own = own.where(F.size("v") == width)
    drawn = min(SAMPLE_ROWS, max(256, SAMPLE_BYTES // (8 * width)))
    sample = own.orderBy(F.xxhash64("id"), "id", "v").limit(drawn).select("v").toArrow()
    quantiser = fit(vectors(sample["v"]), max(1, min(MOST_CENTROIDS, isqrt(total // CELL_ROWS), sample.num_rows)))
    margin = NormalDist().inv_cdf(1 - min(0.5, lost * k / total))
    shared = spark.sparkContext.broadcast(quantiser)
    kind = own.schema["v"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cells = pa.array(shared.value.cells(vectors(batch.column(1))), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=["id", "v", "cell"])

    index = written(own.mapInArrow(placed, f"id long, v {kind}, cell int"), "index")
    # At most as many rows as pairs of centroids.
    found = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(quantiser.size**2, np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    layout = Layout.of(counts, max(1 << 10, SHARD_BYTES // (8 * width)))
    filled = np.flatnonzero(counts)
    plan = spark.createDataFrame(
        pa.table({"cell": filled.astype(np.int32), "first": layout.first[filled], "parts": layout.parts[filled]})
    )
    shard = F.col("first") + F.pmod(F.xxhash64("id"), "parts")
    index = index.join(F.broadcast(plan), "cell").select(shard.alias("shard"), "id", "v", "cell")
    queries = own.where(asked).groupBy("id").agg(F.min("v").alias("v"))
    queries = written(queries.select(F.col("id").alias("q"), "v"), "queries")
    layout_shared = spark.sparkContext.broadcast((layout, filled))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_layout, own_filled = layout_shared.value
        for batch in batches:
            if not len(batch):
                continue
            x = vectors(batch.column(1))
            for k in range(0, len(batch), 64):
                part = batch.slice(k, 64)
                bounds = part.column(2).to_pylist()
                shards = [
                    routes(x[k + r], shared.value, own_layout, own_filled, None if bounds[r] is None else bounds[r], q, margin)
                    for r, q in enumerate(part.column(0).to_pylist())
                ]
                take = pa.array(np.repeat(np.arange(len(part)), [len(s) for s in shards]))
                columns = [pa.array(np.concatenate(shards), pa.int64()), *(c.take(take) for c in part.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "q", "v", "nearest"])

    def searched(asking: pa.Table, held: pa.Table) -> pa.Table:
        out = [[], [], []]
        if asking.num_rows and held.num_rows:
            own_shard = Shard(held["id"].to_numpy(), vectors(held["v"]), held["cell"].to_numpy().astype(np.int64), shared.value, margin)
            bounds = asking["nearest"].to_pylist()
            for q, v, bound in zip(asking["q"].to_pylist(), vectors(asking["v"]), bounds, strict=True):
                ids, scores = own_shard.search(q, v, k, -np.inf if bound is None else bound)
                for column, values in zip(out, (np.full(len(ids), q), ids, scores), strict=True):
                    column.append(values)
        types = (pa.int64(), pa.int64(), pa.float64())
        columns = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, types, strict=True)]
        return pa.Table.from_arrays(columns, names=["q", "id", "score"])

    def search(asking: DataFrame, name: str) -> DataFrame:
        """All queries of a round in the shards they go to: blocks of queries, each with the shard's rows."""
        ways = written(asking.mapInArrow(routed, f"shard long, q long, v {kind}, nearest double"), "routes")
        blocks = ways.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("blocks"))
        ways = ways.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("q"), "blocks"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
        held = index.join(blocks, "shard").select("shard", every, "id", "v", "cell")
        left = ways.select("shard", "block", "q", "v", "nearest").groupBy("shard", "block")
        both = left.cogroup(held.groupBy("shard", "block"))
        return written(both.applyInArrow(searched, FOUND), name)

    first = search(queries.withColumn("nearest", F.lit(None).cast("double")), "home")
    bounds = first.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    least = F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf"))
    rest = queries.join(bounds, "q", "left").select("q", "v", F.coalesce(least, F.lit(float("-inf"))).alias("nearest"))
    both = first.unionByName(search(rest, "others"))
    both = both.groupBy("q", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    ranked = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("q", F.col("rank").cast("int").alias("rank"), "id", "score").withColumnsRenamed(names)
