import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainflow.operators import intervals
from trainflow.plans import flow
from trainflow.sources import inventory, landing, tables, watermark
from trainflow.sources.watermark import LoadSpan
from trainflow.spec import FeatureSpec, RunPaths
from trainflow.streaming import stream_ingest

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])

SPANS = [
    (date(2023, 7, 10), date(2023, 9, 22)),
    (date(2023, 7, 10), date(2023, 7, 17)),
    (date(2023, 7, 10), date(2023, 7, 18)),
    (date(2024, 2, 4), date(2024, 3, 5)),
    (date(2021, 12, 31), date(2024, 1, 1)),
    (date(2023, 1, 1), date(2024, 1, 1)),
    (date(2023, 1, 31), date(2023, 4, 30)),
    (date(2023, 7, 10), date(2023, 7, 11)),
]


def windows(start, stop):
    """Brute force over the days of a span."""
    days = (stop - start).days

    def ends(d):
        tomorrow = d + timedelta(days=1)
        if days > 365:
            return tomorrow.year != d.year
        if days > 30:
            return tomorrow.month != d.month
        return days > 7 and d.weekday() == 6

    span = [start + timedelta(days=i) for i in range(days + 1)]
    cuts = [d for d in span if d in (start, stop) or ends(d)]
    return list(zip(cuts, cuts[1:]))


@pytest.mark.parametrize("start, stop", SPANS)
def test_windows_cover_the_span(spark, start, stop):
    spine = intervals.interval_spine(spark, start, stop).orderBy("window_start").collect()
    assert [tuple(r) for r in spine] == windows(start, stop)


@pytest.mark.parametrize("start, stop", SPANS)
def test_every_row_falls_into_its_window(spark, start, stop):
    first, days = start - timedelta(days=3), (stop - start).days + 6
    rows = spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).cast("timestamp").alias("at"))
    counted = intervals.rows_per_interval(rows, "at", start, stop).orderBy("window_start").collect()
    assert [tuple(r) for r in counted] == [(a, b, (b - a).days) for a, b in windows(start, stop)]


def test_equal_dates_need_no_load(spark):
    assert intervals.interval_spine(spark, date(2024, 1, 1), date(2024, 1, 1)).count() == 0


def test_slice_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.timestamp_seconds(F.col("id") * 86400).alias("at"), "id").write.parquet(path)
    for kind in ("timestamp", "timestamp_ntz", "date"):
        typed = f"{path}_{kind}"
        spark.read.parquet(path).withColumn("at", F.col("at").cast(kind)).write.parquet(typed)
        part = intervals.slice_between(spark.read.parquet(typed), "at", date(1970, 1, 3), date(1970, 1, 5))
        assert [r.id for r in part.orderBy("id").collect()] == [2, 3]
        assert "GreaterThanOrEqual(at" in part._jdf.queryExecution().toString()


def test_requests_fill_both_dates(spark):
    spine = intervals.interval_spine(spark, date(2024, 1, 1), date(2024, 1, 3))
    request = intervals.window_requests(spine, "x?a=<todate>&b=<fromdate>").first().request
    assert request == "x?a=2024-01-03&b=2024-01-01"


def test_watermark_resumes_where_the_last_load_ended(spark, tmp_path):
    path = str(tmp_path / "state")
    early, day = date(2020, 1, 1), date(2023, 8, 1)
    assert watermark.loads(spark, path) is None
    assert watermark.next_span(spark, path, early, day) == LoadSpan(watermark.EARLIEST, day)
    watermark.record_load(spark, path, LoadSpan(watermark.EARLIEST, day), "store")
    assert watermark.next_span(spark, path, early, date(2023, 9, 1)) == LoadSpan(day, date(2023, 9, 1))
    assert watermark.next_span(spark, path, early, day).empty
    watermark.record_load(spark, path, LoadSpan(day, date(2023, 9, 1)), "store")
    assert watermark.last_end(spark, path) == date(2023, 9, 1)
    assert watermark.loads(spark, path).count() == 2


def land(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, content in files.items():
        (folder / f"{name}.json").write_text(content)
    return str(folder)


def test_arrays_lines_bad_text_and_empty_files(spark, tmp_path):
    path = land(
        tmp_path / "in",
        array=json.dumps([{"id": 1, "name": "a"}, {"id": 2, "name": None}]),
        lines='{"id": 3, "name": "c"}\n{"id": 4, "name"\n',
        empty="",
        nothing="[]",
    )
    store = str(tmp_path / "store")
    landing.compact(spark, path, RECORD, store)
    assert {(r.id, r.name) for r in landing.read_store(spark, store).collect()} == {(1, "a"), (2, None), (3, "c")}
    bad = landing.read_quarantine(spark, store).collect()
    assert [(r.payload, r.error_msg) for r in bad] == [('{"id": 4, "name"', landing.BAD_PAYLOAD)]


def test_repeating_a_named_load_adds_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    path = land(tmp_path / "in", lines='{"id": 1}\n{"id": 2}\nbad')
    for load in ("a", "a", "b"):
        landing.compact(spark, path, RECORD, store, load)
    assert sorted(r.id for r in landing.read_store(spark, store).collect()) == [1, 1, 2, 2]
    assert landing.read_store(spark, store).columns == ["id", "name"]
    assert landing.read_quarantine(spark, store).count() == 2


def test_the_unit_can_be_chosen(spark):
    spine = intervals.interval_spine(spark, date(2024, 1, 15), date(2024, 3, 2), "month").orderBy("window_start")
    cuts = [date(2024, 1, 15), date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 2)]
    assert [tuple(r) for r in spine.collect()] == list(zip(cuts, cuts[1:]))
    assert intervals.interval_spine(spark, date(2020, 1, 1), date(2024, 1, 1), None).count() == 1


def test_bad_lines(spark, tmp_path):
    path = land(tmp_path / "in", lines='{"id": 3}\nnot json\n')
    lines = landing.scan_lines(spark, path, RECORD)
    assert [r.payload for r in landing.bad_lines(lines).collect()] == ["not json"]


def test_elements_without_envelope_are_left_out(spark, tmp_path):
    payload = [{"_source": {"id": 1, "name": "a"}, "score": 2}, {"other": 1}, {"_source": {"id": 2}}]
    path = land(tmp_path / "in", array=json.dumps(payload), bad="{")
    envelopes = T.StructType([T.StructField("_source", RECORD)])
    unwrapped = landing.unwrap(landing.scan_json(spark, path, envelopes))
    assert {(r.id, r.name) for r in unwrapped.collect()} == {(1, "a"), (2, None)}
    store = str(tmp_path / "store")
    landing.compact_enveloped(spark, path, RECORD, store)
    assert {(r.id, r.name) for r in landing.read_store(spark, store).collect()} == {(1, "a"), (2, None)}
    assert landing.read_quarantine(spark, store).count() == 1


def test_files_with_other_columns_are_read_together(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([(1,)], "a int"), path)
    tables.append(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert {tuple(r) for r in tables.read_table(spark, path, merge=True).select("a", "b").collect()} == {(1, None), (2, "x")}


def test_ways_to_write(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    assert tables.read_if_present(spark, path) is None
    tables.create(df, path, ["p"])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.create(df, path)
    tables.replace(spark.createDataFrame([("b", 9)], "p string, v int"), path, ["p"])
    assert {(r.p, r.v) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 9)}
    tables.replace(df, path + "2")
    tables.replace(df.where("v = 1"), path + "2")
    assert tables.read_if_present(spark, path + "2").count() == 1


def test_inventory_and_input_check(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "a int, b int").coalesce(1).write.parquet(str(tmp_path / "good"))
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(str(tmp_path / "bad"))
    (tmp_path / "x.csv").write_text("12345")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "y.csv").write_text("1")
    found = inventory.file_inventory(spark, str(tmp_path), "csv").collect()
    assert {(r.path.rsplit("/", 1)[1], r.length) for r in found} == {("x.csv", 5), ("y.csv", 1)}
    checked = inventory.check_inputs(spark, [str(tmp_path / "good"), str(tmp_path / "bad")], ["a", "b"])
    assert inventory.split_inputs(checked) == ([str(tmp_path / "good")], [str(tmp_path / "bad")])
    assert [r.missing_columns for r in inventory.input_report(spark, checked).where("NOT valid").collect()] == [["b"]]


def test_stream_takes_each_file_once(spark, tmp_path):
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    path = land(tmp_path / "in", one='{"id": 1, "name": "a"}\nbroken')
    stream_ingest(spark, path, RECORD, store, checkpoint).awaitTermination()
    land(tmp_path / "in", two='{"id": 2, "name": "b"}')
    for _ in range(2):
        stream_ingest(spark, path, RECORD, store, checkpoint).awaitTermination()
    assert sorted(r.id for r in landing.read_store(spark, store).collect()) == [1, 2]
    assert [r.payload for r in landing.read_quarantine(spark, store).collect()] == ["broken"]


def test_good_elements_of_an_array_are_kept_beside_bad_ones(spark, tmp_path):
    lines = '[{"id": 1}, {"id": 2}]\n[{"id": 3}, {"id": "x"}, null, {"id": 4, "name": "d"}, 7]\n[{"id": 5},{"id"\n\n[]\n'
    path, store = land(tmp_path / "in", lines=lines), str(tmp_path / "store")
    landing.compact(spark, path, RECORD, store)
    assert sorted(r.id for r in landing.read_store(spark, store).collect()) == [1, 2, 3, 4, 5]
    bad = sorted(tuple(r) for r in landing.read_quarantine(spark, store).collect())
    unfit, broken = landing.UNFIT_PAYLOAD, landing.BAD_PAYLOAD
    assert bad == [("7", unfit), ("null", unfit), ('{"id"', broken), ('{"id": "x"}', unfit)]
    scanned = landing.scan_json(spark, path, RECORD)
    assert scanned.count() == 9 and landing.good_payloads(scanned).count() == 5
    assert landing.good_payloads(scanned).select("name").count() == 5


def test_a_load_repeated_later_replaces_itself(spark, tmp_path):
    paths, start = RunPaths(str(tmp_path), "r"), date(2024, 1, 1)
    (tmp_path / "runs" / "r").mkdir(parents=True)
    land(tmp_path / "runs" / "r" / "landing", a='{"id": 1}\nbad\n{"id": 2}')
    landing.compact(spark, paths.landing, RECORD, paths.feature_store, f"from-{start}")
    (tmp_path / "runs" / "r" / "landing" / "a.json").write_text('{"id": 1}\n{"id": 2}\n{"id": 3}')
    rows = flow.ingest(spark, RECORD, LoadSpan(start, date(2024, 1, 3)), paths)
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3]
    assert landing.read_quarantine(spark, paths.feature_store).count() == 0


def test_no_landing_files_move_the_watermark(spark, tmp_path):
    paths = RunPaths(str(tmp_path), "r")
    assert flow.ingest(spark, RECORD, LoadSpan(date(2024, 1, 1), date(2024, 1, 2)), paths).count() == 0
    (tmp_path / "runs" / "r" / "landing").mkdir(parents=True)
    assert flow.ingest(spark, RECORD, LoadSpan(date(2024, 1, 2), date(2024, 1, 3)), paths).count() == 0
    assert watermark.last_end(spark, paths.watermarks) == date(2024, 1, 3)


def test_stream_and_batch_share_a_store(spark, tmp_path):
    first, second = land(tmp_path / "a", x='[{"id": 1}, {"id": "y"}]'), land(tmp_path / "b", x='{"id": 2}')
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "cp")
    for _ in range(2):
        stream_ingest(spark, first, RECORD, store, checkpoint).awaitTermination()
    landing.compact(spark, second, RECORD, store)
    assert sorted(r.id for r in landing.read_store(spark, store).collect()) == [1, 2]
    assert landing.read_quarantine(spark, store).count() == 1


@pytest.mark.parametrize("name", ["load", "payload_ok", "Error_Msg", "_corrupt_record"])
def test_clashing_names_are_refused(spark, tmp_path, name):
    record = T.StructType([T.StructField("id", T.LongType()), T.StructField(name, T.StringType())])
    path = land(tmp_path / "in", x='{"id": 2}')
    with pytest.raises(ValueError, match=name.lower()):
        landing.compact(spark, path, record, str(tmp_path / "store"))
    with pytest.raises(ValueError, match=name.lower()):
        stream_ingest(spark, path, record, str(tmp_path / "store"), str(tmp_path / "cp"))


def test_validate_refuses_columns_it_would_replace(spark, tmp_path):
    spec = FeatureSpec(target="y", key=("k",))
    for name in ("split", "accepted"):
        df = spark.createDataFrame([(1, "a", 2)], f"k long, y string, {name} int")
        with pytest.raises(ValueError, match=name):
            flow.validate(df, spec, RunPaths(str(tmp_path), "r"))
