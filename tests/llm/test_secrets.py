"""Secret scans beside plain patterns on every text."""

import hashlib
import random
import re

import pytest

from trainflow.llm import secrets
from trainflow.llm.catalog import op2_secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def brute(text):
    found = [(a, i, k, b) for i, k in enumerate(["assign", "access", "hex"]) for kk, a, b in base(text) if kk == k]
    for i, rule in enumerate(secrets.MORE, 3):
        found += [(m.start(), i, rule.kind, m.end()) for m in re.finditer(rule.pattern, text)]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


PIECES = ["token", "TOKEN", "Api_Key", "apikey", "pass", "word", "passwd", " ", "  ", ":", "=", '"', "'", "AKIA", "ABCDEFGH01234567"]
PIECES += ["0123456789abcdef", "deadbeef", "é", "\n", "ſecret=abcdef", "toKen = x", "ghp_", "a1B2" * 9, "xoxb-", "AIza", "sk_live_"]
PIECES += ["eyJhbGciOiJIUzI1", ".", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----", "x.y=z", "日本", "K"]


def test_random_texts():
    rng = random.Random(2)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(4000)] + [None, "", "ab"]
    assert secrets.scan(texts) == [brute(t or "") for t in texts]


@pytest.mark.parametrize(
    ("pattern", "text", "query"),
    [
        ("abcd", "xabcdx", {frozenset([b"abc", b"bcd"])}),
        ("ab(c|de)f?g", "", {frozenset([b"abc", b"bcf", b"cfg"]), frozenset([b"abc", b"bcg"])}),
        ("[0-9a-f]{24,}", "", {frozenset()}),
        ("a+", "", {frozenset()}),
        ("AKIA[A-Z0-9]{16,}", "", {frozenset([b"aki", b"kia"])}),
        ("(one|two)x*(three|y)", "", {frozenset([b"one"]), frozenset([b"two"])}),
    ],
)
def test_queries(pattern, text, query):
    got = secrets.trigram_query(pattern)
    assert {frozenset(x) for x in got} >= set() and (got == secrets.ANY) == (query == {frozenset()})
    if pattern in ("abcd", "AKIA[A-Z0-9]{16,}", "(one|two)x*(three|y)"):
        assert set(got) == query


def test_queries_hold_for_every_match():
    rng = random.Random(4)
    for rule in secrets.RULES:
        query = secrets.trigram_query(rule.pattern)
        for _ in range(3000):
            text = "".join(rng.choices(PIECES, k=8))
            for m in rule.regex.finditer(text):
                low = m[0].encode().lower()
                assert any(all(t in low for t in x) for x in query)
    assert secrets.trigram_query(secrets.BASE[2].pattern) == secrets.ANY


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op2_secret_scan(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        own, r = base(d.text or ""), rows[d.doc_id]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, _, _ in own) for x in ("assign", "access", "hex")]
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in brute(d.text or ""))
    assert any(r.spans for r in rows.values())


def test_odd_rows_keep_their_columns(spark):
    rows = [(None, "token=abcdefg", "x"), (1, None, "y"), (1, "", "y"), (2, "secret: " + "a" * 300_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    found = secrets.with_spans(df)
    assert found.columns == ["doc_id", "text", "kind", "spans"]
    got = sorted((len(r.text or ""), [tuple(s) for s in r.spans]) for r in found.collect())
    assert got[:3] == [(0, []), (0, []), (13, [("assign", 0, 13)])]
    assert got[3][1] == [("assign", 0, 300_008), ("hex", 8, 300_008)]
    assert secrets.with_spans(df.limit(0)).count() == 0
