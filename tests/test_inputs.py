"""Input files on any path and of any type, and their way into the archive."""

import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import functions as F

from trainflow.plans import scoring
from trainflow.sources import files, inventory
from trainflow.spec import FeatureSpec, RunPaths

SPEC = FeatureSpec(target="y", key=("id",), categorical=("c",), numeric=("n",), date_pairs=(("sent", "got", "days"),), text="t")
ROWS = "id long, c string, n double, t string, sent timestamp, got timestamp"


class Echo(Transformer):
    """A model that gives what it reads: the type of each column and its value as text."""

    def _transform(self, dataset):
        parts = [F.concat_ws(" ", F.typeof(c), F.col(c).cast("string")) for c in ("id", "c", "n", "t", "sent")]
        return dataset.withColumn("prediction_y", F.concat_ws("|", *parts))


class Registry:
    def load_newest(self, key):
        return PipelineModel(stages=[Echo()])


def table(spark, *ids, **change):
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    moment = F.to_timestamp(F.lit("2024-01-02 03:04:05"))
    rows = rows.select("id", F.lit("x").alias("c"), (F.col("id") / 2).alias("n"), F.lit("words").alias("t"), moment.alias("sent"), moment.alias("got"))
    return rows.withColumns(change)


def scored(spark, inputs, paths):
    report = scoring.score_files(spark, SPEC, Registry(), "m", inputs, paths)
    return report, sorted(r.prediction_y for r in spark.read.parquet(paths.predictions).collect())


@pytest.fixture
def store(spark, tmp_path):
    """A path that only Spark's readers can open, and the local folder behind it."""
    name = f"s{abs(hash(str(tmp_path)))}"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    (tmp_path / "behind").mkdir()
    conf.set(f"fs.viewfs.mounttable.{name}.link./in", f"file://{tmp_path}/behind")
    return f"viewfs://{name}/in", tmp_path / "behind"


def test_a_path_that_only_spark_opens(spark, store):
    far, near = store
    table(spark, 1, 2).coalesce(1).write.parquet(f"{far}/good")
    table(spark, 3).drop("c").coalesce(1).write.parquet(f"{far}/old")
    (near / "text").mkdir()
    (near / "text" / "a.parquet").write_text("no table at all, but long enough for a footer")
    inputs = [f"{far}/{n}" for n in ("good", "old", "text")]
    found = {r.input.rpartition("/")[2]: r for r in inventory.check_files(spark, inputs, ["c", "n"]).collect()}
    assert found["good"].reason is None and found["good"].path.startswith(far)
    assert found["old"].reason == "Missing columns: ['c']" and found["text"].reason == "Unreadable: no Parquet file"
    paths = RunPaths(f"{far}/run", "r")
    report, _ = scored(spark, inputs, paths)
    assert report.valid == inputs[:1] and set(report.invalid) == set(inputs[1:])
    assert spark.read.parquet(paths.archive).count() == 2 and spark.read.parquet(f"{paths.failed}/0").count() == 1


def test_files_that_spark_did_not_write(spark, tmp_path):
    for i in range(3):
        pq.write_table(pa.table({"a": [i], "b": pa.array([[1.5]], pa.list_(pa.float32()))}), tmp_path / f"{i}.parquet")
    pq.write_table(pa.table({"a": ["x"]}), tmp_path / "s.parquet")
    found = inventory.check_files(spark, [str(tmp_path)], ["a"]).collect()
    kinds = {r.path.rpartition("/")[2][0]: inventory.T.StructType.fromJson(inventory.json.loads(r.schema)).simpleString() for r in found}
    both = "struct<a:bigint,b:array<float>>"
    assert kinds == {"0": both, "1": both, "2": both, "s": "struct<a:string>"}


def test_what_is_no_table(spark, tmp_path):
    (tmp_path / "empty.parquet").write_text("")
    (tmp_path / "short").write_text("PAR1")
    table(spark, 1).coalesce(1).write.parquet(str(tmp_path / "t"))
    part = next((tmp_path / "t").glob("*.parquet"))
    whole = part.read_bytes()
    (tmp_path / "cut.parquet").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "broken.parquet").write_bytes(whole[:40] + b"\xff" * (len(whole) - 48) + whole[-8:])
    found = {r.path.rpartition("/")[2]: r for r in inventory.check_files(spark, [str(tmp_path)], ["c"]).collect()}
    assert {n for n, r in found.items() if r.reason is None} == {part.name}
    assert all(r.reason.startswith("Unreadable") and r.schema is None for n, r in found.items() if n != part.name)


def test_a_storage_that_does_not_answer_raises(spark, tmp_path):
    table(spark, 1).coalesce(1).write.parquet(str(tmp_path / "t"))
    part = next((tmp_path / "t").glob("*.parquet"))
    with pytest.raises(Exception, match="FileNotFound|No such file|does not exist"):
        inventory._footer(spark, f"{part}-gone")


def test_absent_and_empty_inputs(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    table(spark, 1).write.parquet(str(tmp_path / "here"))
    inputs = [str(tmp_path / n) for n in ("gone", "empty", "here")]
    checked = inventory.check_inputs(spark, inputs, ["n", "c"])
    assert checked == {inputs[0]: ["c", "n"], inputs[1]: ["c", "n"], inputs[2]: []}
    reasons = {r.path: r.reason for r in inventory.check_files(spark, inputs[:2], ["c"]).collect()}
    assert reasons == {inputs[0]: "Path does not exist", inputs[1]: "No files"}
    report, found = scored(spark, inputs, RunPaths(str(tmp_path / "root"), "r"))
    assert report.valid == inputs[2:] and set(report.invalid) == set(inputs[:2]) and len(found) == 1


def test_types_of_all_files_are_brought_together(spark, tmp_path):
    table(spark, 1).write.parquet(str(tmp_path / "in" / "a"))
    text = {"id": F.lit("seven"), "n": F.lit("1.5"), "sent": F.lit("2024-01-02"), "extra": F.lit(1)}
    table(spark, 7, **text).write.parquet(str(tmp_path / "in" / "b"))
    table(spark, 8, id=F.lit(None).cast("int"), n=F.lit("none"), c=F.lit(5)).write.parquet(str(tmp_path / "in" / "c"))
    table(spark, 9, t=F.array("t"), n=F.lit(b"x")).write.parquet(str(tmp_path / "in" / "d"))
    paths = RunPaths(str(tmp_path / "root"), "r")
    report, found = scored(spark, [str(tmp_path / "in")], paths)
    assert found == [
        "string 1|string x|double 0.5|string words|timestamp 2024-01-02 03:04:05",
        "string seven|string x|double 1.5|string words|timestamp 2024-01-02 00:00:00",
        "string|string 5|double|string words|timestamp 2024-01-02 03:04:05",
    ]
    assert report.valid == list(report.invalid) == [str(tmp_path / "in")]
    failed = spark.read.parquet(f"{paths.failed}/0").first()
    assert failed.id == 9 and failed.error_msg == "Unfit types: ['n binary', 't array<string>']"


def test_types_that_all_files_have_are_kept(spark, tmp_path):
    table(spark, 1, n=F.lit(3)).write.parquet(str(tmp_path / "in"))
    _, found = scored(spark, [str(tmp_path / "in")], RunPaths(str(tmp_path / "root"), "r"))
    assert found == ["bigint 1|string x|int 3|string words|timestamp 2024-01-02 03:04:05"]


def test_names_with_wildcards_and_nested_inputs(spark, tmp_path):
    odd = tmp_path / "in" / "odd [1]{a}*"
    table(spark, 1).coalesce(1).write.parquet(str(tmp_path / "plain"))
    odd.mkdir(parents=True)
    shutil.copy(next((tmp_path / "plain").glob("*.parquet")), odd / "x.parquet")
    table(spark, 2).write.parquet(str(tmp_path / "in" / "inner"))
    inputs = [str(tmp_path / "in"), str(tmp_path / "in" / "inner")]
    found = inventory.check_files(spark, inputs, ["c"]).collect()
    assert {r.input for r in found if "inner/" in r.path} == {inputs[1]}
    report, rows = scored(spark, [str(tmp_path / "i*")], RunPaths(str(tmp_path / "root"), "r"))
    assert len(rows) == 2 and report.valid == [str(tmp_path / "i*")]


def test_scored_files_are_moved_and_not_read_for_it(spark, tmp_path):
    for day in (1, 2):
        table(spark, day).coalesce(1).write.parquet(str(tmp_path / "in" / f"day={day}"))
    before = {p.name: p.read_bytes() for p in (tmp_path / "in").rglob("*.parquet")}
    paths = RunPaths(str(tmp_path / "root"), "r")
    scored(spark, [str(tmp_path / "in")], paths)
    after = {p.name: p.read_bytes() for p in (tmp_path / "root").rglob("archive/**/*.parquet")}
    assert after == before and not list((tmp_path / "in").rglob("*.parquet"))
    assert sorted((r.id, r.day) for r in spark.read.parquet(paths.archive).collect()) == [(1, 1), (2, 2)]
    table(spark, 3).write.parquet(str(tmp_path / "in" / "day=3"))
    _, found = scored(spark, [str(tmp_path / "in")], paths)
    assert len(found) == 1 and spark.read.parquet(paths.archive).count() == 3


@pytest.mark.parametrize("made", [0, 1, 2])
def test_moves_that_broke_off_are_ended(spark, tmp_path, monkeypatch, made):
    for day in (1, 2, 3):
        table(spark, day).coalesce(1).write.parquet(str(tmp_path / "in" / f"day={day}"))
    paths, done = RunPaths(str(tmp_path / "root"), "r"), []

    def crash(spark, source, target):
        if len(done) == made:
            raise ConnectionError("gone")
        done.append(source)
        files.move(spark, source, target)

    monkeypatch.setattr(scoring, "move", crash)
    monkeypatch.setattr(scoring, "FOOTERS", 1)
    with pytest.raises(ConnectionError):
        scored(spark, [str(tmp_path / "in")], paths)
    monkeypatch.setattr(scoring, "move", files.move)
    report, found = scored(spark, [str(tmp_path / "in")], paths)
    assert report.valid == [str(tmp_path / "in")] and len(found) == 3
    assert spark.read.parquet(paths.archive).count() == 3 and not list((tmp_path / "in").rglob("*.parquet"))
