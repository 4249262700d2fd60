"""The divergence audit beside a version that keeps every count of every group."""

import random
import re
from collections import Counter

from trainflow.llm import divergence

WORDS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long"


def plain(docs, least, smooth=5, scale=10**9, top=50):
    rows = [(lang or "", source or "", WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for t, lang, source in docs]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = Counter(w for r in own for w in set(r[2]))
        kept = sorted(w for w in df if df[w] >= least)

        def shares(some):
            counts = Counter(w for r in some for w in r[2])
            total = sum(counts[w] for w in kept)
            return {w: 1 + scale * (counts[w] + smooth) // (total + smooth * len(kept)) for w in kept}, counts

        every = shares(own)[0]
        groups = {s: shares([r for r in own if r[1] == s]) for s in {r[1] for r in own}}
        for s, (p, counts) in groups.items():
            pairs = [(sum(abs(p[w] - q[w]) for w in kept), t) for t, (q, _) in groups.items() if t != s]
            terms = [(p[w] - every[w], w) for w in kept if counts[w] and p[w] > every[w]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def result(spark, docs, **more):
    df = spark.createDataFrame([(i, *d, "x", 1) for i, d in enumerate(docs)], SCHEMA)
    return sorted(tuple(r) for r in divergence.audit(df, **more).collect())


def test_equals_dense_counts(spark):
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in "abcdéß日" for b in "xyzÀ"]

    def text():
        words = rng.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=rng.randint(0, 60))
        return rng.choice([" ", ", ", "1", "\n"]).join(w.upper() if rng.random() < 0.2 else w for w in words)

    docs = [(text(), rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "é", None])) for _ in range(120)]
    docs += [(None, "en", "empty"), ("", "xx", "s0"), ("12 34", "xx", "s1"), ("rare words", "yy", "s0")] + [("Ab ab AB", "en", "s0")] * 9
    for least, top in ((3, 50), (12, 4), (1, 1000)):
        assert result(spark, docs, least_docs=least, top=top) == plain(docs, least, top=top)


def test_no_rows_no_words_one_source(spark):
    assert result(spark, []) == []
    assert result(spark, [("a b", "en", "s")] * 40) == plain([("a b", "en", "s")] * 40, 30) == []
    none = [("a", "en", "s"), ("b", "en", "t")]
    assert result(spark, none) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_words_of_long_texts_in_blocks(monkeypatch):
    rng = random.Random(5)
    for block in (1, 2, 5, 64):
        monkeypatch.setattr(divergence, "BLOCK", block)
        for _ in range(200):
            text = "".join(rng.choices("aBé日 1.\u0085", k=rng.randint(0, 40)))
            found = [w.decode() for part in divergence.words(text.encode()) for w in part]
            assert found == [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORDS.findall(text)]


def test_tasks_that_hold_few_words(spark, monkeypatch):
    counts = divergence._Counts()
    assert [counts.add("en", "s", b"a b a"), counts.add("en", "t", b"b c")] == [2, 2]
    rows = [r for batch in counts.rows() for r in batch.to_pylist()]
    assert {(r["source"], r["term"], r["n"], r["docs"]) for r in rows} == {
        ("s", None, 0, 0), ("s", b"a", 2, 1), ("s", b"b", 1, 1), ("t", None, 0, 0), ("t", b"b", 1, 1), ("t", b"c", 1, 1)
    }
    assert counts.held() == 0


def test_pairs_in_small_steps(monkeypatch):
    import pyarrow as pa

    rng = random.Random(6)
    lists = [[{"g": g, "p": rng.randint(1, 99), "z": 7 + g} for g in sorted(rng.sample(range(9), rng.randint(1, 9)))] for _ in range(50)]
    kind = pa.list_(pa.struct([("g", pa.int64()), ("p", pa.int64()), ("z", pa.int64())]))
    plain = Counter()
    for one in lists:
        for i, a in enumerate(one):
            for b in one[i + 1 :]:
                x = abs(a["p"] - b["p"]) - abs(a["p"] - b["z"]) - abs(a["z"] - b["p"]) + abs(a["z"] - b["z"])
                plain[a["g"], b["g"]] += x
    for step in (1, 3, 1 << 20):
        monkeypatch.setattr(divergence, "PAIRS", step)
        batches = [pa.RecordBatch.from_arrays([pa.array(lists[i : i + 7], kind)], names=["s"]) for i in range(0, 50, 7)]
        found = Counter()
        for batch in divergence._shared_pairs(iter(batches)):
            for r in batch.to_pylist():
                found[r["a"], r["b"]] += r["x"]
        assert {k: v for k, v in found.items() if v} == {k: v for k, v in plain.items() if v}
