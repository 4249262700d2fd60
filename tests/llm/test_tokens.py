"""Encoding, record files and packing beside plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.fs as pafs
import pytest
from tokenizers import Tokenizer

from trainflow.llm import packing, records, tokens
from trainflow.llm.catalog import byte_bpe, op5_token_records, op7_best_fit_packing

SMALL = "/root/testdata/sf0.001"
ODD = ["a  b", "a   b", "\n a", " a", "a ", "a  b ", "x\x1f y", "<|endoftext|> hi <|endoftext|>", "it's 's I'll", "日本 語 é"]
ODD += ["", "a\tb c\n\nd e", "é ü  ", " ", "x  y", "a 　b", "12 34a ,b !? ..", "\n", "a\n b", "A" * 3000, "\x00 \x00"]


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    return own


def test_encoder_equals_the_library(library, monkeypatch):
    rng = random.Random(1)
    letters = "ab  \n\té日.,'1 "
    texts = ODD + ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for words, characters in ((10, 50), (10**6, 10**6)):
        monkeypatch.setattr(tokens, "MOST_WORDS", words)
        monkeypatch.setattr(tokens, "CHARACTERS", characters)
        own = tokens.Encoder(byte_bpe())
        assert [x.tolist() for x in own.encode(texts)] == expected
    assert [x.tolist() for x in own.encode([None])] == [[]]


def plain(library, rows, end):
    return [(k, [*library.encode(t or "", add_special_tokens=False).ids, end]) for k, t in rows]


def test_records_query_reads_back_what_the_library_gives(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected, start = [], 0
    for k, ids in plain(library, sorted(map(tuple, docs)), 0):
        expected.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, op5_token_records(spark, SMALL).collect())) == expected


def test_record_files_odd_rows_and_shuffled_reads(spark, library):
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(None, "no key"), (9, None), (9, "again"), (9, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as k", "2 as t")
    files = records.write(df, byte_bpe(), 0)
    expected = Counter((k, tuple(ids)) for k, ids in plain(library, rows, 0))
    got = records.read(files).orderBy("start").collect()
    assert Counter((r.key, tuple(r.ids)) for r in got) == expected
    keys = [-1 if r.key is None else r.key for r in got]
    assert keys == sorted(keys)
    assert [r.start for r in got] == [sum(len(x.ids) for x in got[:i]) for i in range(len(got))]
    drawn = [(r.key, r.start, r.ids) for r in records.read_shuffled(files, 4).collect()]
    assert drawn != [tuple(r) for r in got] and sorted(drawn, key=lambda r: r[1]) == [tuple(r) for r in got]


def test_damaged_record_raises(spark):
    files = records.write(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), byte_bpe(), 0)
    path = files.first()["path"]
    system, base = pafs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
    good = system.open_input_stream(f"{base}.rec").read()
    for place in range(len(good)):
        bad = bytearray(good)
        bad[place] ^= 1
        with pytest.raises(ValueError, match="record"):
            records.unframed(pafs.LocalFileSystem().open_input_stream(_kept(spark, bytes(bad))))


def _kept(spark, data):
    from trainflow.workspace import new_folder

    folder = new_folder(spark, "damaged").removeprefix("file://")
    pafs.LocalFileSystem().create_dir(folder, recursive=True)
    with open(f"{folder}/x", "wb") as f:
        f.write(data)
    return f"{folder}/x"


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert records.round_trip(spark, df, byte_bpe(), 0).count() == 0
    assert packing.pack(df, byte_bpe(), 2).count() == 0


def check_packing(rows, documents, size):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    expected = Counter()
    for k, ids in documents:
        cuts = [0, *range((len(ids) - 1) % size + 1, len(ids) + 1, size)]
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            expected[k, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    total = sum(len(ids) for _, ids in documents)
    return len(by_sequence), -(-total // size)


def test_packing_query(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    used, least = check_packing(op7_best_fit_packing(spark, SMALL).collect(), plain(library, map(tuple, docs), 2), 1024)
    assert used <= least * 1.02 + 1


def test_packing_odd_rows(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "TOGETHER", 5)
    rows = [(i % 7, t) for i, t in enumerate(ODD * 3)] + [(None, "x y"), (None, None), (1, "a b c")] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as length", "2 as piece")
    check_packing(packing.pack(df, byte_bpe(), 2, size=16, ids=True).collect(), plain(library, rows, 2), 16)


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_the_histogram(seed):
    rng = np.random.default_rng(seed)
    size = 64
    lengths = rng.integers(1, size + 1, rng.integers(1, 400)) if seed else rng.integers(1, size + 1, 200_000)
    histogram = Counter(lengths.tolist())
    plan = packing.planned(histogram, size)
    held = Counter()
    for shape, many in plan.items():
        assert sum(shape) <= size and many > 0
        for v in shape:
            held[v] += many
    assert held == histogram
    assert sum(plan.values()) <= 1.01 * sum(packing.best_fit(histogram, size).values()) + 1


def test_queries_give_what_an_unchanged_tokenizer_gives(spark, tmp_path):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    parts = ["<|endoftext|>", " ", "x", "é", "\n", "y z", "<|", "|>", "endoftext"]
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b  <|endoftext|> c d", *ODD]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(300)]
    expected = [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert expected[0] == [87, 220, 50256, 331]
    assert [x.tolist() for x in tokens.Encoder(byte_bpe(), as_text=False).encode(texts)] == expected
    rows = list(enumerate(texts))
    folder = tmp_path / "data"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{folder}/documents.parquet")
    found, start = [], 0
    for k, ids in plain(own, rows, 0):
        found.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, op5_token_records(spark, str(folder)).collect())) == found
    check_packing(op7_best_fit_packing(spark, str(folder)).collect(), plain(own, rows, 2), 1024)
