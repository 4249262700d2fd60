"""SimHash near-duplicates beside a version that compares every pair."""

import numpy as np
import pytest
import xxhash

from trainflow.llm import simhash
from trainflow.llm.components import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    bits = 0
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    for k in range(64):
        if 2 * sum(h >> k & 1 for h in hashes) > len(hashes):
            bits |= 1 << k
    return bits


def brute_components(rows, bits=3):
    prints = {k: brute_fingerprint(t) for k, t in rows}
    up = {k: k for k in prints}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: (prints[k], root(k)) for k in keys}


def result(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(df).collect()
    return {r.doc_id: (r.fingerprint & (2**64 - 1), r.component_id) for r in found}


def test_whole_table_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(len(rows) + i + 1000, t + " more words") for i, (_, t) in enumerate(rows[:40]) if t]
    assert result(spark, rows) == brute_components(rows)


def test_short_empty_null_and_repeated(spark):
    rows = [(5, None), (3, ""), (4, " \t\n"), (9, "One"), (8, "oNE"), (7, "a b"), (6, "a b c d"), (2, "É a b")]
    assert result(spark, rows) == brute_components(rows)
    df = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "x y")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(df).collect()] == [1, 1, 1]


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, f string, k string, fingerprint int, root int")
    assert simhash.near_duplicates(df).columns == ["doc_id", "fingerprint", "component_id"]
    assert simhash.near_duplicates(df).count() == 0


@pytest.mark.parametrize("bits", [3, 5])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, bits):
    """Clusters, boundary rows, several blocks per shard, and chains longer than one link."""
    monkeypatch.setattr(simhash, "LEAST_SAMPLED", 200)
    monkeypatch.setattr(simhash, "SHARD_ROWS", 40)
    monkeypatch.setattr(simhash, "DIRECT", 8)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 60, dtype=np.uint64)
    prints = set()
    for c in centres.tolist():
        x = c
        for _ in range(int(rng.integers(1, 60))):
            for k in rng.integers(0, 64, 2).tolist():
                x ^= 1 << k
            prints.add(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    roots = components(simhash.links(df, max_bits=bits), "a", "b").collect()
    got = {r.node: r.root for r in roots}
    keys = sorted(prints)
    up = {k: k for k in keys}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    assert {k: got.get(k, k) for k in keys} == {k: root(k) for k in keys}


def test_components_of_a_long_chain(spark):
    links = spark.range(0, 300).selectExpr("id * 7 % 300 as x")
    chain = links.selectExpr("x as a", "x + 1 as b")
    roots = components(chain, "a", "b").collect()
    assert len(roots) == 301 and {r.root for r in roots} == {0}
