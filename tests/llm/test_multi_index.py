"""Nearest vectors beside a product with every row."""

import math
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trainflow.llm import catalog, multi_index

SMALLEST = Path("/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<double>, label int, q long, id long, v string"
ASKED = "id % 20 = 0"


def result(spark, rows, k=20, schema=SCHEMA, **more):
    df = spark.createDataFrame([(i, v, 0, 1, 2, "x") for i, v in rows], schema)
    out = {}
    for r in multi_index.nearest(df, F.expr(ASKED), k, **more).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(found) for q, found in out.items()}


def plain(rows, k=20):
    """Ids by rounded product and id; a key with several rows counts with its nearest."""
    out, every = {}, np.array([w for _, w in rows])
    for i, v in sorted(rows):
        if i % 20 or i in out:
            continue
        best = {}
        for (j, _), score in zip(rows, (every * np.array(v)).sum(1).tolist(), strict=True):
            if j != i:
                best[j] = max(best.get(j, -math.inf), score)
        order = sorted(best, key=lambda j: (-best[j], j))[:k]
        out[i] = [(n + 1, j, best[j]) for n, j in enumerate(order)]
    return {q: found for q, found in out.items() if found}


def recall(found, expected):
    hits = sum(len({j for _, j, _ in found[q]} & {j for _, j, _ in rows}) for q, rows in expected.items())
    return hits / sum(len(rows) for rows in expected.values())


def scores_hold(found, rows):
    vectors = dict(rows)
    for q, hits in found.items():
        assert [n for n, _, _ in hits] == list(range(1, len(hits) + 1))
        assert [(s, -j) for _, j, s in hits] == sorted(((s, -j) for _, j, s in hits), reverse=True)
        for _, j, s in hits:
            assert s == pytest.approx(float(np.dot(vectors[q], vectors[j])), rel=1e-12, abs=1e-12)


def cloud(rng, n, width, clusters=0, tight=0.05):
    x = rng.standard_normal((n, width))
    if clusters:
        x = rng.standard_normal((clusters, width))[rng.integers(0, clusters, n)] + tight * x
    return x * rng.uniform(0.1, 3, (n, 1))


@pytest.mark.parametrize("clusters", [0, 30, 400])
def test_recall(spark, monkeypatch, clusters):
    monkeypatch.setattr(multi_index, "SAMPLE_ROWS", 1_000)
    x = cloud(np.random.default_rng(clusters), 6_000, 24, clusters)
    rows = list(enumerate(x.tolist()))
    found, expected = result(spark, rows), plain(rows)
    assert found.keys() == expected.keys()
    assert all(len(hits) == 20 for hits in found.values())
    assert recall(found, expected) >= 0.9
    scores_hold(found, rows)


def test_group_of_copies_in_many_shards(spark, monkeypatch):
    """A third of all rows are equal: their cell is dealt out to several shards and ties go by key."""
    monkeypatch.setattr(multi_index, "SHARD_BYTES", 1)  # 1024 rows a shard
    x = cloud(np.random.default_rng(1), 6_000, 8)
    x[::3] = x[0]
    rows = list(enumerate(x.tolist()))
    found, expected = result(spark, rows), plain(rows)
    assert recall(found, expected) >= 0.9
    assert found[60] == expected[60]
    scores_hold(found, rows)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 0.5]), (1, [1.0, 0.0, 0.0]), (2, [2.0, 2.0, 2.0]), (20, [-1.0, 0.0, 1.0])]
    bad = [(3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (7, [nan, 1.0, 1.0]), (40, [inf, 1.0, 1.0])]
    bad += [(8, [1.0, 2.0]), (60, [-0.0, 0.0, 0.0]), (80, None), (None, [9.0, 9.0, 9.0])]
    assert result(spark, rows + bad) == plain(rows)
    assert result(spark, bad[:6] + bad[-3:]) == {}
    assert result(spark, []) == {}
    assert result(spark, [(0, [1.0])]) == {}
    assert result(spark, [(0, [1.0]), (3, [2.0]), (20, [-5.0])]) == plain([(0, [1.0]), (3, [2.0]), (20, [-5.0])])


def test_repeated_rows_and_ties(spark):
    rows = [(0, [1.0, 1.0])] * 3 + [(0, [5.0, 0.0])] + [(i % 30, [float(i % 4), 1.0]) for i in range(1, 200)] + [(7, [3.0, 1.0])] * 50
    rows = [r for r in rows if r[0] % 20 or r[0] == 0]
    assert result(spark, rows, k=20) == plain(rows)
    assert result(spark, rows, k=3) == plain(rows, 3)


def test_very_large_and_small_components(spark):
    rng = np.random.default_rng(5)
    for scale in (1e-140, 1e-30, 1e30, 1e140):
        rows = [(i, (scale * v).tolist()) for i, v in enumerate(cloud(rng, 400, 6))]
        found = result(spark, rows)
        assert recall(found, plain(rows)) >= 0.9


def test_single_precision_and_odd_width(spark):
    x = cloud(np.random.default_rng(6), 900, 7).astype(np.float32)
    rows = [(i - 450, v) for i, v in enumerate(x.tolist())]
    found = result(spark, rows, schema=SCHEMA.replace("array<double>", "array<float>"))
    assert recall(found, plain(rows)) >= 0.9
    scores_hold(found, rows)


def test_layout_holds_every_cell():
    rng = np.random.default_rng(7)
    for _ in range(50):
        counts = rng.integers(0, 40, 60) * (rng.random(60) < 0.6)
        layout = multi_index.Layout.of(counts, 25)
        load = {}
        for cell in np.flatnonzero(counts):
            for part in range(layout.parts[cell]):
                load[layout.first[cell] + part] = load.get(layout.first[cell] + part, 0) + counts[cell] / layout.parts[cell]
        assert max(load.values(), default=0) <= 25
        assert set(load) == set(range(len(load)))
        assert (layout.parts[counts == 0] == 0).all()


def test_heap_gives_all_pairs_in_order():
    rng = np.random.default_rng(8)
    quantiser = multi_index.fit(rng.standard_normal((200, 6)), 5)
    x = rng.standard_normal((300, 6))
    shard = multi_index.Shard(np.arange(300), x, quantiser.cells(x), quantiser, 3.0)
    a, b = rng.standard_normal(len(shard.rows)), rng.standard_normal(len(shard.columns))
    pairs = list(shard.pairs(a, b))
    assert {(i, j) for _, i, j in pairs} == {(i, j) for i in range(len(a)) for j in range(len(b))}
    assert [g for g, _, _ in pairs] == sorted((g for g, _, _ in pairs), reverse=True)
    ids, scores = shard.search(-1, x[3], 10, -np.inf)
    assert len(ids) == 10 and (np.diff(scores) <= 0).all()


@pytest.mark.skipif(not SMALLEST.exists(), reason="test tables not present")
def test_query_on_whole_table(spark):
    table = pq.read_table(SMALLEST / "embeddings.parquet")
    rows = list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist(), strict=True))
    df = catalog.op12_nearest_vectors(spark, str(SMALLEST))
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    found = {}
    for r in df.collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    found = {q: sorted(hits) for q, hits in found.items()}
    assert recall(found, plain(rows)) >= 0.9
    scores_hold(found, rows)
