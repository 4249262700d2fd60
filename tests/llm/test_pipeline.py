"""The pipeline's stages, each on its own input, beside plain versions."""

import numpy as np
import pytest
from test_decontaminate import brute as contaminated
from test_line_dedup import brute as without_lines
from test_line_dedup import order_key
from test_simhash import brute_components
from test_tokens import check_packing, library, plain  # noqa: F401

import corpus_pipeline as pipeline
from trainflow.llm import quality

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def stage(spark, name, docs, folder=FOLDER):
    out = dict(pipeline.STAGES)[name](spark, docs, folder)
    if name != "best-fit packing":
        assert out.columns == docs.columns
    return out


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, very long, equal and repeated rows, and columns with other names in use."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(12).collect()
    passage = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first().text
    rows = [tuple(r) for r in docs] * 2
    rows += [(None, None, None, None, None), (900, None, "en", "s", 3), (901, "", "en", "s", 0), (902, "\n\n", None, "s", 2)]
    rows += [(903, passage, "en", "s", len(passage)), (904, "word " * 30_000, "en", "s", 1), (None, "no key", "en", "s", 6)]
    rows += [(905, docs[0].text, "en", "s", None), (903, passage + " and more", "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, row string, h string, k int, d int"
    return spark.createDataFrame([(*r, 1, "r", "h", 2, 3) for r in rows], schema)


def check_quality(spark, docs):
    kept = rows_of(stage(spark, "quality classifier", docs))
    machine = quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = docs.collect()
    stated = np.array([np.nan if r.n_chars is None else r.n_chars for r in rows], float)
    score = machine.score(quality.inputs([None if r.text is None else r.text.encode() for r in rows], stated))
    assert kept == sorted((tuple(r) for r, s in zip(rows, score, strict=True) if s >= 0.5), key=repr)


def check_lines(spark, docs):
    rows = [tuple(r) for r in docs.collect()]
    expected = []
    for r, (_, text, _, removed) in zip(rows, without_lines([r[:2] for r in rows], in_order=True), strict=True):
        expected.append((r[0], text, *r[2:4], len(text) if removed else r[4], *r[5:]))
    assert rows_of(stage(spark, "line dedup", docs)) == sorted(expected, key=repr)


def check_near(spark, docs):
    rows = [tuple(r) for r in docs.collect()]
    names = sorted({r[:2] for r in rows}, key=order_key)
    groups = brute_components([(i, t) for i, (_, t) in enumerate(names)])
    expected = sorted((names[i] for i, (_, c) in groups.items() if c == i), key=repr)
    kept = rows_of(stage(spark, "simhash near-dedup", docs))
    assert sorted((r[:2] for r in kept), key=repr) == expected and set(kept) <= set(rows)


def check_benchmark(spark, docs):
    rows = [tuple(r) for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for i, *_, c in contaminated([(i, r[1]) for i, r in enumerate(rows)], items) if c}
    expected = sorted((r for i, r in enumerate(rows) if i not in bad), key=repr)
    assert rows_of(stage(spark, "benchmark decontamination", docs)) == expected
    return bad


def check_pack(spark, docs, own):
    rows = [tuple(r)[:2] for r in docs.collect()]
    check_packing(stage(spark, "best-fit packing", docs).collect(), plain(own, rows, 2), 1024)


def test_stages_on_the_table(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert docs.columns == COLUMNS
    check_quality(spark, docs)
    check_lines(spark, docs)
    check_near(spark, docs)
    assert check_benchmark(spark, docs)
    check_pack(spark, docs, library)


def test_stages_on_odd_rows(spark, odd, library):  # noqa: F811
    check_quality(spark, odd)
    check_lines(spark, odd)
    check_near(spark, odd)
    assert check_benchmark(spark, odd)
    check_pack(spark, odd, library)


def test_stages_on_no_rows(spark, odd):
    for name, _ in pipeline.STAGES:
        assert stage(spark, name, odd.limit(0)).count() == 0


def test_run_gives_what_the_stages_give(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, _ in pipeline.STAGES[:-1]:
        docs = stage(spark, name, docs)
    rows = [tuple(r)[:2] for r in docs.collect()]
    check_packing(pipeline.run(spark, FOLDER).collect(), plain(library, rows, 2), 1024)
