"""Substring dedup beside a version that compares every window."""

import random
import re

import pytest

from trainflow.llm import substrings, words

LAST = (1 << 63) - 1


def brute(docs):
    split = [(LAST if k is None else k, re.findall("[^\x20\x09-\x0d]+", t or "")) for k, t in docs]
    first = {}
    for k, w in split:
        for i in range(len(w) - 49):
            window = tuple(w[i : i + 50])
            first[window] = min(k, first.get(window, k))
    out = []
    for (key, _), (k, w) in zip(docs, split, strict=True):
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < k:
                gone.update(range(i, i + 50))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def result(spark, docs, parts=3):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    return sorted([tuple(r) for r in substrings.without_repeats(df).collect()], key=repr)


def planted(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choices([f"w{i}" for i in range(400)] + ["Éa", "日本"], k=n))
    passages = [text(n) for n in (49, 50, 51, 60, 95, 200)]
    docs = []
    for i in range(80):
        parts = [text(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(passages), text(rng.randint(0, 60))]
        docs.append((i, "\n ".join(parts)))
    docs += [(100 + i, docs[rng.randrange(80)][1]) for i in range(30)]
    docs += [(200, None), (201, ""), (202, " \t"), (203, "short copy"), (204, "short copy"), (205, "a " * 300)]
    docs += [(-1, docs[3][1]), (3, docs[3][1]), (3, docs[9][1]), (None, docs[4][1]), (206, "a " * 120)]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(spark, seed):
    docs = planted(seed)
    assert result(spark, docs) == brute(docs)


def test_small_batches_and_blocks(spark, monkeypatch):
    """Runs that go on over batches, rows combined in some batches only."""
    docs = planted(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert result(spark, docs, 2) == brute(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, k string, u int, d string, p int")
    found = substrings.without_repeats(df)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept"] and found.count() == 0


def test_cover_meets_every_difference():
    n = substrings.PERIOD
    assert {(a - b) % n for a in substrings.COVER for b in substrings.COVER} == set(range(n))
    assert substrings.ANCHOR + n - 1 == substrings.WINDOW


def test_hashes_do_not_depend_on_the_place():
    import numpy as np

    data = np.frombuffer(b"abc xabc abc", np.uint8)
    starts, ends = words.spans(data, words.NOT_SPACE)
    a, b, c = words.hashes(data, starts, ends).tolist()
    assert a == c != b
