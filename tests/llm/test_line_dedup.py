"""Line dedup beside a version that compares every pair of lines."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from trainflow.llm import line_dedup
from trainflow.llm.catalog import op10_line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def order_key(row):
    k, t = row
    digest = xxhash.xxh64_intdigest((t or "").encode(), seed=42)
    return ((1 << 63) - 1 if k is None else k, digest - (1 << 64) if digest >> 63 else digest)


def brute(rows, edits=2, least=24, in_order=False):
    """Rows of key and text; equal rows count once for the order."""
    order = sorted(set(rows), key=order_key)
    lines = {}
    for k, t in order:
        for i, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                lines.setdefault(line, (order_key((k, t)), i))
    names = sorted(lines)
    up = {n: n for n in names}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    long = [n for n in names if len(n) >= least]
    for i, a in enumerate(long):
        for b in long[i + 1 :]:
            if abs(len(a) - len(b)) <= edits and root(a) != root(b) and distance(a, b) <= edits:
                up[root(a)] = root(b)
    first = {}
    for n in names:
        first[root(n)] = min(first.get(root(n), lines[n]), lines[n])
    out = []
    for k, t in rows:
        if t is None:
            out.append((k, None, 0, 0))
            continue
        own = t.split("\n")
        kept = [x for i, x in enumerate(own) if not x.strip(" ") or first[root(x)] == (order_key((k, t)), i)]
        out.append((k, "\n".join(kept), len(own), len(own) - len(kept)))
    return out if in_order else sorted(out, key=repr)


def result(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = line_dedup.deduplicated(df)
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect()], key=repr)


def changed(rng, line):
    for _ in range(rng.randint(0, 3)):
        i = rng.randrange(len(line))
        line = rng.choice([line[:i] + line[i + 1 :], line[:i] + "zé"[rng.randrange(2)] + line[i:], line[:i] + "q" + line[i + 1 :]])
    return line


def test_near_equals_the_plain_distance(spark):
    rng = random.Random(1)
    pairs = [("", ""), ("", "a"), ("", "abc"), ("ab", "c"), ("a", "aaa"), ("日本語", "日本"), ("😀x", "😁x")]
    for _ in range(400):
        a = "".join(rng.choices("abé", k=rng.randint(0, 14)))
        b = a
        for _ in range(rng.randint(0, 5)):
            i = rng.randint(0, len(b))
            b = rng.choice([b[:i] + rng.choice("abé") + b[i:], b[:i] + b[i + 1 :], b[:i] + "c" + b[i + 1 :]])
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2, 3):
        rows = df.withColumn("x", line_dedup.near(F.col("a"), F.col("b"), edits)).collect()
        assert [r.x for r in rows] == [distance(r.a, r.b) <= edits for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_lines(spark, seed):
    rng = random.Random(seed)
    letters = "abcdefgh éñ日"
    base = ["".join(rng.choices(letters, k=rng.randint(1, 90))) for _ in range(40)]
    rows = []
    for k in range(50):
        own = [changed(rng, x) if x else x for x in rng.choices(base, k=rng.randint(1, 8))]
        own += ["".join(rng.choices(letters, k=40)), rng.choice(["", "  ", "short", "shorT"])]
        rows.append((k, "\n".join(own)))
    rows += [(60, rows[3][1]), (60, rows[3][1]), (3, rows[4][1]), (61, None), (62, ""), (63, "\n\n"), (None, rows[5][1])]
    assert result(spark, rows) == brute(rows)


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in op10_line_dedup(spark, folder).collect()}
    expected = brute(rows)
    assert sum(n for *_, n in expected) > 0
    assert got == {k: (n, m, hashlib.sha256((t or "").encode()).hexdigest()) for k, t, n, m in expected}


def test_columns_stay(spark):
    df = spark.createDataFrame([(1, "a\na", "x", 7)], "doc_id long, text string, lost string, n_lines int")
    found = line_dedup.deduplicated(df)
    assert found.columns == ["doc_id", "text", "lost", "n_lines", "n_removed"]
    assert [tuple(r) for r in found.collect()] == [(1, "a", "x", 2, 1)]
    assert line_dedup.deduplicated(df.limit(0)).count() == 0
    plain = line_dedup.deduplicated(df.select("doc_id", "text").withColumn("h", F.lit(1)).withColumn("key", F.lit(2)))
    assert plain.count() == 1


def test_frequent_segments_link_through_others(spark):
    """Many variants of one long line: one class, and no variant is lost."""
    line = "x" * 10 + "".join(chr(97 + i % 26) for i in range(200))
    rows = [(i, line[:i] + "#" + line[i + 1 :]) for i in range(200)]
    assert [r for r in result(spark, rows) if r[1]] == [(0, rows[0][1], 1, 0)]


@pytest.mark.parametrize("hot", [1, 3])
def test_keys_of_many_lines_are_parted(spark, monkeypatch, hot):
    """Lines that share their beginning, end or middle, and near copies of some, with nearly every key hot."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rng = random.Random(hot)
    word = lambda n: "".join(rng.choices("abc", k=n))
    lines = []
    for _ in range(60):
        same, free = "2024-01-01 INFO request handler ", word(rng.choice([4, 12, 30, 70]))
        lines += [rng.choice([same + free, free + same, free[:5] + same + free[5:], "a" * rng.randint(24, 60)])]
    for line in rng.sample(lines, 40):
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(line))
            line = rng.choice([line[:at] + "x" + line[at:], line[:at] + line[at + 1 :], line[:at] + "y" + line[at + 1 :]])
        lines.append(line)
    rows = [(i, line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in line_dedup.deduplicated(df).collect()), key=repr)
    assert found == sorted(brute(rows), key=repr)


def test_columns_named_like_helpers_stay(spark):
    names = ["__d", "__x", "__met", "__lost", "__lines", "__word", "__bit", "__bits", "__D_"]
    df = spark.createDataFrame([(1, "a\nb", *["v"] * 8), (2, "a\nc", *["w"] * 8)], ["doc_id", "text", *names[:8]])
    found = sorted(line_dedup.deduplicated(df).collect())
    assert [r["text"] for r in found] == ["a\nb", "c"]
    assert all(r[n] == ("v" if r["doc_id"] == 1 else "w") for r in found for n in names[:8])
