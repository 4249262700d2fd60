"""Benchmark decontamination beside a version that slides every window over every document."""

import random
import re

import pytest

from trainflow.llm import decontaminate

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = []
    for k, t in items:
        w = split(t)
        n = min(13, len(w))
        windows += [(k, w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for k, t in docs:
        w, hit, named = split(t), set(), set()
        for item, part in windows:
            for i in range(len(w) - len(part) + 1):
                if w[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    named.add("" if item is None else str(item))
        out.append((k, len(w), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def result(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(d, b).collect()
    return sorted([tuple(r) for r in found], key=repr)


def test_planted_passages(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "straße", "日本", "x"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.randint(0, 40))) for i in range(30)] + [(3, text(20)), (None, text(14)), (77, None), (78, "")]
    items += [(90, items[5][1]), (91, "one Two THREE"), (92, "solo")]
    docs = []
    for i in range(60):
        body = text(rng.randint(0, 80))
        own = (items[i % 30][1] or "").split(" ")
        a = rng.randint(0, max(0, len(own) - 12))
        part = ", ".join(own[a : a + rng.randint(11, 15)]).upper()
        docs.append((i, f"{body}. {part} -- {text(5)} one two three."))
    docs += [(100, None), (101, ""), (102, "..."), (0, docs[0][1]), (None, docs[1][1]), (103, "Solo"), (104, text(30000))]
    assert result(spark, docs, items) == brute(docs, items)


def test_no_items_no_documents(spark):
    assert result(spark, [(1, "a b")], []) == [(1, 2, 0, [], False)]
    assert result(spark, [], [(1, "a b")]) == []


def test_clean_keeps_rows_without_hits(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    rows = [(1, "fine", "x"), (2, passage, "x"), (3, None, None), (4, passage + " q" * 300, "x"), (2, passage, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontaminate.clean(df, items)
    assert kept.columns == ["doc_id", "text", "h"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_blocks_do_not_matter(spark, monkeypatch, piece):
    """Words longer than a block, texts split over many blocks."""
    from trainflow.llm import words

    monkeypatch.setattr(words, "BLOCK", piece)
    texts = [("ab " * 20).encode(), None, b"", ("x" * 40 + " yy zz").encode()]
    got = list(decontaminate._scan(texts, None, 3, 2, None))
    assert [n for n, _ in got] == [20, 0, 0, 3]
    assert [len(f) for _, f in got] == [18, 0, 0, 1]
    assert len({f["digest"] for f in got[0][1]}) == 1
