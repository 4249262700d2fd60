"""Logs of numbered entries, the ledger of loads, and streams that begin anew."""

import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainflow.sources import files, landing
from trainflow.sources.files import Conflict, NumberedLog
from trainflow.sources.ledger import Loads
from trainflow.streaming import stream_ingest

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def land(folder, **content):
    folder.mkdir(exist_ok=True)
    for name, text in content.items():
        (folder / f"{name}.json").write_text(text)
    return str(folder)


def ids(spark, store):
    return sorted(r.id for r in landing.read_store(spark, store, RECORD).collect())


@pytest.fixture(params=["local", "hadoop"])
def folder(request, spark, tmp_path, monkeypatch):
    """A folder whose files are made by hard links, and one where Hadoop renames them."""
    if request.param == "hadoop":
        monkeypatch.setattr(files, "urlparse", lambda path: type("Other", (), {"scheme": "hdfs"}))
    return str(tmp_path / "log")


def test_a_file_is_written_once(spark, folder):
    assert files.read_text(spark, f"{folder}/a") is None and files.names(spark, folder) == []
    assert files.create_new(spark, f"{folder}/a", "é\n")
    assert not files.create_new(spark, f"{folder}/a", "other")
    assert files.read_text(spark, f"{folder}/a") == "é\n"
    assert files.names(spark, folder) == ["a"] or all(n == "a" or n.startswith(".") for n in files.names(spark, folder))


def test_writers_get_different_numbers(spark, tmp_path):
    logs = [NumberedLog(spark, str(tmp_path / "log")) for _ in range(8)]
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: logs[i % 8].append({"i": i}), range(150)))
    assert sorted(numbers) == list(range(1, 151))
    entries = NumberedLog(spark, str(tmp_path / "log")).entries()
    assert [e["number"] for e in entries] == list(range(1, 151))
    assert sorted(e["i"] for e in entries) == list(range(150))
    assert {n for n in files.names(spark, str(tmp_path / "log")) if n.endswith(".all")} == {f"{64:020d}.all", f"{128:020d}.all"}


def test_one_of_two_writers_is_refused(spark, folder):
    log = NumberedLog(spark, folder)
    assert log.last() == 0 and log.entries() == []
    log.append({"a": 1})
    seen = log.last()
    assert log.append({"a": 2}, after=seen) == 2
    with pytest.raises(Conflict):
        log.append({"a": 3}, after=seen)
    assert [e["a"] for e in log.entries()] == [1, 2]


def test_moves_do_not_overwrite(spark, tmp_path):
    (tmp_path / "a").write_text("1")
    (tmp_path / "b").write_text("2")
    files.move(spark, str(tmp_path / "a"), str(tmp_path / "new" / "deep" / "a"))
    assert (tmp_path / "new" / "deep" / "a").read_text() == "1"
    with pytest.raises(Exception, match="exists"):
        files.move(spark, str(tmp_path / "b"), str(tmp_path / "new" / "deep" / "a"))


def test_an_emptied_load_has_no_rows(spark, tmp_path):
    store, path = str(tmp_path / "store"), land(tmp_path / "in", x='{"id": 1}\n{"id": 2}')
    landing.compact(spark, path, RECORD, store, "a")
    landing.compact(spark, land(tmp_path / "other", y='{"id": 3}\nbad'), RECORD, store, "b")
    shutil.rmtree(path)
    landing.compact(spark, path, RECORD, store, "a")
    assert ids(spark, store) == [3]
    assert landing.read_store(spark, store).columns == ["id", "name"]
    report = {r["name"]: (r["rows"], r["good"]) for r in Loads(spark, store).report().collect()}
    assert report == {"a": (0, 0), "b": (2, 1)}
    shutil.rmtree(tmp_path / "other")
    landing.compact(spark, str(tmp_path / "other"), RECORD, store, "b")
    assert ids(spark, store) == [] and landing.read_store(spark, store).count() == 0


def test_an_attempt_that_broke_off_is_not_read(spark, tmp_path):
    store = str(tmp_path / "store")
    landing.compact(spark, land(tmp_path / "in", x='{"id": 1}'), RECORD, store, "a")
    rows = spark.createDataFrame([(9, None, None, None, True)], T.StructType(
        [*RECORD.fields, T.StructField(landing.CORRUPT, T.StringType()), T.StructField("error_msg", T.StringType()), T.StructField("payload_ok", T.BooleanType())]
    ))
    rows.write.parquet(f"{store}/load=a/attempt=lost")
    assert ids(spark, store) == [1]
    landing.compact(spark, land(tmp_path / "in", x='{"id": 2}'), RECORD, store, "a")
    gone = Loads(spark, store).forget()
    assert len(gone) == 1 and ids(spark, store) == [2]
    assert Loads(spark, store).forget() == []
    assert "attempt=lost" in files.names(spark, f"{store}/load=a")


def test_names_of_loads_may_hold_any_character(spark, tmp_path):
    store = str(tmp_path / "store")
    for i, name in enumerate(["a/b", "a=b", "é %2F", "..", "a:b"]):
        landing.compact(spark, land(tmp_path / "in", x=f'{{"id": {i}}}'), RECORD, store, name)
    assert ids(spark, store) == [0, 1, 2, 3, 4]


def test_columns_added_later(spark, tmp_path):
    store = str(tmp_path / "store")
    landing.compact(spark, land(tmp_path / "in", x='{"id": 1}'), T.StructType(RECORD.fields[:1]), store)
    landing.compact(spark, land(tmp_path / "in", x='{"id": 2, "name": "b"}'), RECORD, store)
    assert {tuple(r) for r in landing.read_store(spark, store).select("id", "name").collect()} == {(1, None), (2, "b")}
    assert ids(spark, store) == [1, 2]


def test_nothing_loaded(spark, tmp_path):
    assert landing.read_store(spark, str(tmp_path / "none"), RECORD).count() == 0
    with pytest.raises(LookupError, match="nothing was loaded"):
        landing.read_store(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("old_files_stay", [True, False])
def test_a_stream_that_begins_anew_keeps_earlier_rows(spark, tmp_path, old_files_stay):
    store, checkpoint = str(tmp_path / "store"), tmp_path / "checkpoint"
    path = land(tmp_path / "in", one='{"id": 1}\n{"id": 2}', two='{"id": 3}')
    stream_ingest(spark, path, RECORD, store, str(checkpoint)).awaitTermination()
    for number in (4, 5):
        shutil.rmtree(checkpoint)
        if not old_files_stay:
            shutil.rmtree(path)
        land(tmp_path / "in", **{f"file{number}": f'{{"id": {number}}}'})
        stream_ingest(spark, path, RECORD, store, str(checkpoint)).awaitTermination()
    assert ids(spark, store) == [1, 2, 3, 4, 5]
    land(tmp_path / "in", file5='{"id": 55, "name": "changed since"}')
    shutil.rmtree(checkpoint)
    stream_ingest(spark, path, RECORD, store, str(checkpoint)).awaitTermination()
    assert ids(spark, store) == [1, 2, 3, 4, 5, 55]


def test_two_streams_into_one_store(spark, tmp_path):
    store = str(tmp_path / "store")
    for name in "ab":
        path = land(tmp_path / name, x=f'{{"id": {ord(name)}}}')
        for _ in range(2):
            stream_ingest(spark, path, RECORD, store, str(tmp_path / f"checkpoint-{name}")).awaitTermination()
    assert ids(spark, store) == [97, 98]
    streams = Loads(spark, store).report().where("stream IS NOT NULL")
    assert streams.select("stream").distinct().count() == 2 and streams.agg(F.sum("files")).first()[0] == 2
