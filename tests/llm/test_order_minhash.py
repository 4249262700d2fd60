"""Order MinHash beside a plain version, and what its likeness follows."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from trainflow.llm import order_minhash as omh
from trainflow.llm.catalog import op4_order_minhash

MASK = (1 << 64) - 1


def spark_hash(*values):
    """Spark's xxhash64 of texts and numbers, signed."""
    seed = 42
    for v in values:
        if v is None:
            continue
        if isinstance(v, str):
            raw = v.encode()
        else:
            size, v = v
            raw = (v & (1 << 8 * size) - 1).to_bytes(size, "little")
        seed = xxhash.xxh64_intdigest(raw, seed=seed & MASK)
    return seed - (1 << 64) if seed >> 63 else seed


def brute(text):
    words = re.split("[ \t\n\r\f\x0b]+", (text or "").strip(" \t\n\r\f\x0b"))
    seen, found = {}, []
    for i in range(max(1, len(words) - omh.K + 1)):
        digest = spark_hash(*words[i : i + omh.K])
        digest = (digest << 24 & MASK) >> 24
        digest -= (1 << 40) if digest >> 39 else 0
        occurrence = seen.get(digest, 0)
        seen[digest] = occurrence + 1
        found.append((digest, occurrence, i))
    slots = {}
    for turn in range(-(-omh.THROWS // len(found))):
        for digest, occurrence, i in found:
            h = spark_hash((8, digest), (4, occurrence), (4, turn))
            slots.setdefault(h >> 58, []).append((turn, h >> 34 & 0xFFFFFF, i))
    out = [None] * omh.SLOTS
    for slot, thrown in slots.items():
        thrown.sort()
        kept = thrown[:1] + [t for t in thrown if t[2] != thrown[0][2]][:1]
        pair = [(8, slot << 34 | turn << 24 | rank) for turn, rank, _ in sorted(kept, key=lambda t: t[2])]
        out[slot + omh.SLOTS // 2] = (spark_hash(*pair) & 0xFFFF) - 0x8000
    return out


def signatures(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in omh.signed(df, "t", "x").orderBy("i").collect()]


def test_signature_equals_the_plain_version(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["a", "b", "cé", "d", "日本"], k=rng.randint(0, 300))) for _ in range(40)]
    texts += [None, "", " \t\n", "one", "one two", "\n a  b\tc \r", "x " * 500, "a b a b a b"]
    assert signatures(spark, texts) == [brute(t) for t in texts]


def test_likeness_follows_order_and_edits(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10_000)}" for _ in range(2000)]
    texts = [words, words[:1900] + words[:100], words[:1000] + words[:1000], words[1000:] + words[:1000], words[::-1]]
    rows = signatures(spark, [" ".join(t) for t in texts])
    df = spark.createDataFrame([(rows[0], r) for r in rows], "a array<smallint>, b array<smallint>")
    near = [r.x for r in df.select(omh.likeness(F.col("a"), F.col("b")).alias("x")).collect()]
    assert near[0] == 1 and near[1] > 0.75 and near[1] > near[2] and near[4] < 0.05
    assert near[3] < 0.75  # the same words in another order


@pytest.mark.parametrize("words", [20, 40, 65, 100, 130, 300, 1000])
def test_order_shows_at_any_length(spark, words):
    """Texts of different words with their halves swapped: pairs keep their order half of the time."""
    rng = random.Random(words)
    texts = [[f"w{x}" for x in rng.sample(range(100_000), words)] for _ in range(50)]
    rows = [(" ".join(t), " ".join(t[words // 2 :] + t[: words // 2]), " ".join(t[:-1])) for t in texts]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    df = omh.signed(omh.signed(omh.signed(df, "a", "x"), "b", "y"), "c", "z")
    near = df.select(omh.likeness(F.col("x"), F.col("y")).alias("s"), omh.likeness(F.col("x"), F.col("z")).alias("e"))
    swapped, shorter = near.agg(F.avg("s"), F.avg("e")).first()
    assert 0.35 < swapped < 0.6
    assert shorter > 0.85


def expected(rows):
    texts = {}
    for k, t in rows:
        key = omh.FIRST_KEY if k is None else k
        texts.setdefault(key, []).append(t or "")
    order = sorted(texts, reverse=True)
    standing = {k: min(texts[k], key=spark_hash) for k in order}
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    out = []
    for k, t in rows:
        t, n = t or "", len(t or "") // 3
        follower = standing[after[omh.FIRST_KEY if k is None else k]]
        edited = t[: len(t) - n] + follower[:n]
        a, b, c = brute(t), brute(edited), brute(follower)
        near = lambda x, y: sum(p == q is not None for p, q in zip(x, y, strict=True)) / sum(
            p is not None or q is not None for p, q in zip(x, y, strict=True)
        )
        out.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, near(a, b), near(a, c)))
    return out


def test_neighbours_and_odd_rows(spark):
    rows = [(5, "a b c d e f g h i é"), (3, "日本 語 x y z" * 9), (9, None), (8, ""), (None, "no key at all"), (5, "other text here")]
    rows += [(-7, "last one before the null key"), (3, "日本 語 x y z" * 9), (100, "word " * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as k", "2 as d", "'x' as t")
    found = omh.fingerprints(df)
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.slots, r.edited_slots, r.near_edited, r.near_next) for r in found.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for a, b in zip(sorted(got, key=key), sorted(expected(rows), key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


@pytest.mark.parametrize("rows", [[], [(1, "only one document here")]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.near_next for r in omh.fingerprints(df).collect()] == [1.0] * len(rows)


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    got = sorted(op4_order_minhash(spark, folder).collect())
    digits = lambda x: "".join("----" if v is None else f"{v + 0x8000:04x}" for v in x)
    for r, e in zip(got, expected(docs), strict=True):
        assert tuple(r)[:3] == e[:3] and (r.fingerprint, r.edited_fingerprint) == (digits(e[3]), digits(e[4]))
        assert (r.near_edited, r.near_next) == pytest.approx(e[5:])
