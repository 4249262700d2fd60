"""Arrays cut into elements, whole and in the splits of a file, beside a reader that goes byte by byte."""

import json
import random

import pytest

from trainflow.sources import arrays, landing


def plain(line: str) -> list[str]:
    """Elements of a line, one character after the other."""
    text = line.strip(" \t\r\n")
    if not text.startswith("["):
        return [text] if text else []
    parts, start, depth, quoted, escaped = [], 1, 1, False, False
    for i, c in enumerate(text[1:], 1):
        literal, escaped = escaped, c == "\\" and not escaped
        if c == '"' and not literal:
            quoted = not quoted
        if quoted:
            continue
        if c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
        if depth == 0 or (c == "," and depth == 1):
            parts.append(text[start:i])
            start = i + 1
        if depth == 0:
            break
    parts = [p.strip(" \t\r\n") for p in [*parts, text[start:]]]
    return [p for p in parts if p]


def value(rng, depth=0):
    kind = rng.randint(0, 5 if depth < 3 else 2)
    if kind < 2:
        return rng.choice([1, 1.1, None, True, -5])
    if kind == 2:
        return "".join(rng.choices('ab{}[],"\\ é日:\t', k=rng.randint(0, 12)))
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {f"k{i}": value(rng, depth + 1) for i in range(rng.randint(0, 3))}


def line(rng) -> str:
    kind = rng.random()
    text = json.dumps([value(rng) for _ in range(rng.randint(0, 12))], ensure_ascii=False, separators=rng.choice([(",", ":"), (" , ", ": ")]))
    if kind < 0.15:
        text = json.dumps({"k": value(rng)})
    elif kind < 0.3:
        text = text[: rng.randint(0, len(text))]
    elif kind < 0.4:
        text += rng.choice(["]", "}", " x", ",[1]", '"'])
    elif kind < 0.5:
        text = "".join(rng.choices('[]{},"\\a \t', k=rng.randint(0, 30)))
    return rng.choice(["", "  ", "\t"]) + text + rng.choice(["", " ", "\r"])


def test_every_kind_of_line():
    rng = random.Random(1)
    for _ in range(4_000):
        text = line(rng)
        assert [p.decode() for p in arrays.payloads(text.encode())] == plain(text), text


def test_long_lines_are_indexed_in_blocks(monkeypatch):
    rng = random.Random(2)
    for block in (1, 2, 3, 7):
        monkeypatch.setattr(arrays, "BLOCK", block)
        for _ in range(500):
            text = line(rng)
            assert [p.decode() for p in arrays.payloads(text.encode())] == plain(text), text


@pytest.fixture
def small_splits(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, size if "max" in k else 0) for k in held]
    for k, v in held.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [200, 900])
def test_files_in_splits_equal_files_in_lines(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    expected = []
    for i in range(8):
        lines = [line(rng) for _ in range(rng.randint(0, 7))]
        if i < 2:  # one line a file, with and without an end
            lines = [json.dumps([{"n": k, "t": "a]},{ \\ \" é" * (k % 4)} for k in range(40)])[: None if i else -30]]
        text = "\n".join(lines) + rng.choice(["", "\n"])
        (tmp_path / f"f {i}%.json").write_bytes(text.encode())
        expected += [p for x in text.split("\n") for p in plain(x)]
    small_splits(size)
    found = arrays.read_payloads(spark, str(tmp_path), whole=0)
    assert sorted(r.payload for r in found.collect()) == sorted(expected)
    some = sorted(tmp_path.iterdir())[:3]
    mixed = arrays.read_payloads(spark, str(tmp_path), whole=sorted(p.stat().st_size for p in some)[1])
    assert sorted(r.payload for r in mixed.collect()) == sorted(expected)


def test_more_splits_than_are_sent_at_once(spark, tmp_path, small_splits):
    expected = []
    for i in range(4):
        rows = [{"file": i, "n": k} for k in range(20)]
        (tmp_path / f"{i}.json").write_text(json.dumps(rows))
        expected += [json.dumps(r) for r in rows]
    small_splits(150)
    sizes = {str(p): p.stat().st_size for p in tmp_path.iterdir()}
    found = arrays.split_payloads(spark, sizes, splits_at_once=4)
    assert sorted(r.payload for r in found.collect()) == sorted(expected)


def test_other_splits_in_the_second_pass_are_seen(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "a.json").write_text(json.dumps([{"n": k} for k in range(100)]))
    small_splits(300)
    pieces = arrays._pieces

    def smaller_next(spark, paths):
        found = pieces(spark, paths)
        found.count()
        monkeypatch.setattr(arrays, "_pieces", lambda spark, paths: (small_splits(200), pieces(spark, paths))[1])
        return found

    monkeypatch.setattr(arrays, "_pieces", smaller_next)
    with pytest.raises(Exception, match="not those of the first pass"):
        arrays.read_payloads(spark, str(tmp_path), whole=0).count()


def test_one_line_is_read_by_many_tasks(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps([{"n": k, "text": "word " * 20} for k in range(3_000)]))
    small_splits(20_000)
    pieces = arrays._pieces(spark, [str(tmp_path)])
    assert pieces.rdd.getNumPartitions() >= 15
    found = arrays.read_payloads(spark, str(tmp_path), whole=1_000)
    assert found.count() == 3_000 and found.distinct().count() == 3_000


def test_quarantine_is_verbatim(spark, tmp_path):
    record = "id long, v double"
    (tmp_path / "a.json").write_text('[{"id": 1, "v": 1.10}, "abc", 1.1, {"id":  "x" , "v":1.0}, {"id": 2}, {"id": 3')
    scanned = landing.scan_json(spark, str(tmp_path), landing.T._parse_datatype_string(record))
    assert sorted(r.id for r in landing.good_payloads(scanned).collect()) == [1, 2]
    bad = sorted(r.payload for r in landing.bad_payloads(scanned).collect())
    assert bad == ['"abc"', "1.1", '{"id":  "x" , "v":1.0}', '{"id": 3']


def test_nothing_there(spark, tmp_path):
    assert arrays.read_payloads(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "empty").write_text("")
    assert arrays.read_payloads(spark, str(tmp_path)).count() == 0
    assert arrays.read_payloads(spark, str(tmp_path), whole=-1).count() == 0
