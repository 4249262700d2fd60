"""Calendar windows, incremental slices and JSON payloads made from the events."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainflow.catalog.tables import load
from trainflow.functions import largest_number, row_as_json
from trainflow.operators import intervals
from trainflow.plans import flow
from trainflow.sources import files, landing, watermark
from trainflow.sources.arrays import read_payloads
from trainflow.sources.ledger import Loads
from trainflow.sources.watermark import LoadSpan
from trainflow.spec import RunPaths
from trainflow.streaming import stream_ingest as start_ingest
from trainflow.workspace import new_folder

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
PROPS = T.StructType([T.StructField("k", T.LongType())])


def _span(df, moment) -> tuple[date, date]:
    """First day of the table and the day after its last: the dates a load is asked for."""
    row = df.agg(F.min(moment).cast("date").alias("a"), F.max(moment).cast("date").alias("b")).first()
    return row["a"], row["b"] + timedelta(days=1)


def interval_spine_weeks(spark, folder):
    return intervals.interval_spine(spark, *_span(load(spark, folder, "events"), "ts"))


def interval_spine_years(spark, folder):
    return intervals.interval_spine(spark, *_span(load(spark, folder, "orders"), "o_orderdate"))


def rows_per_week(spark, folder):
    events = load(spark, folder, "events")
    return intervals.rows_per_interval(events, "ts", *_span(events, "ts"))


def rows_per_month(spark, folder):
    items = load(spark, folder, "lineitem")
    return intervals.rows_per_interval(items, "l_shipdate", *_span(items, "l_shipdate"), "month")


def rows_per_year(spark, folder):
    orders = load(spark, folder, "orders")
    return intervals.rows_per_interval(orders, "o_orderdate", *_span(orders, "o_orderdate"))


def window_requests(spark, folder):
    spine = intervals.interval_spine(spark, *_span(load(spark, folder, "events"), "ts"))
    template = "/events?before=<todate>&from=<fromdate>&format=json"
    return intervals.window_requests(spine, template).select("request")


def incremental_slice(spark, folder):
    """A first load ended in the middle of the events; the next one continues there."""
    events = load(spark, folder, "events")
    start, stop = _span(events, "ts")
    middle = start + (stop - start) // 2
    state = new_folder(spark, "watermarks")
    watermark.record_load(spark, state, LoadSpan(start, middle), folder)
    span = watermark.next_span(spark, state, end=stop)
    return intervals.slice_between(events, "ts", span.start, span.end).select("event_id", "event_type", "value")


def _payload(broken):
    """Event records as JSON text, those of the ``broken`` condition without their closing brace."""
    text = row_as_json("event_id", "event_type", "value")
    return F.when(broken, F.replace(text, F.lit("}"), F.lit(""))).otherwise(text)


def _landed(spark, folder):
    """Landing files in which the records of errors are cut off."""
    path = new_folder(spark, "landing")
    events = load(spark, folder, "events")
    events.select(_payload(F.col("event_type") == "error")).write.text(path)
    return path


def json_scan(spark, folder):
    path = new_folder(spark, "landing")
    load(spark, folder, "events").select(EVENT.fieldNames()).write.json(path)
    return landing.good_payloads(landing.scan_json(spark, path, EVENT))


def json_scan_inferred(spark, folder):
    path = new_folder(spark, "landing")
    load(spark, folder, "events").select(EVENT.fieldNames()).write.json(path)
    return landing.scan_json(spark, path)


def json_quarantine(spark, folder):
    return landing.bad_payloads(landing.scan_json(spark, _landed(spark, folder), EVENT))


def json_good_rows(spark, folder):
    return landing.good_payloads(landing.scan_json(spark, _landed(spark, folder), EVENT))


def json_compaction(spark, folder):
    store = new_folder(spark, "store")
    landing.compact(spark, _landed(spark, folder), EVENT, store)
    return landing.read_store(spark, store)


def json_compaction_quarantine(spark, folder):
    store = new_folder(spark, "store")
    landing.compact(spark, _landed(spark, folder), EVENT, store)
    return landing.read_quarantine(spark, store)


def _enveloped(spark, folder):
    """Landing files of ``{"_source": {..}}`` elements; views come as another kind of element."""
    path = new_folder(spark, "landing")
    record = F.struct(*EVENT.fieldNames())
    element = F.when(F.col("event_type") == "view", F.to_json(F.struct(record.alias("_other")))).otherwise(
        F.to_json(F.struct(record.alias("_source")))
    )
    load(spark, folder, "events").select(element).write.text(path)
    return path


def json_envelope_unwrap(spark, folder):
    envelopes = T.StructType([T.StructField(landing.ENVELOPE, EVENT)])
    return landing.unwrap(landing.good_payloads(landing.scan_json(spark, _enveloped(spark, folder), envelopes)))


def json_envelope_compaction(spark, folder):
    store = new_folder(spark, "store")
    landing.compact_enveloped(spark, _enveloped(spark, folder), EVENT, store)
    return landing.read_store(spark, store)


def json_column(spark, folder):
    """JSON in a column: the property of each event, null and flagged where the text is cut off."""
    props = F.when(F.col("event_type") == "error", F.replace("props", F.lit("}"), F.lit(""))).otherwise(F.col("props"))
    events = load(spark, folder, "events").select("event_id", props.alias("props"))
    record = landing.parse_json(events, "props", PROPS)
    good = landing.parsed(F.col("record")[landing.CORRUPT])
    return record.select("event_id", F.when(good, F.col("record.k")).alias("k"), good.alias("payload_ok"))


def rows_as_json(spark, folder):
    return load(spark, folder, "events").select(
        "event_id", row_as_json("event_id", "user_id", "event_type").alias("row_json")
    )


def largest_number_in_url(spark, folder):
    return load(spark, folder, "pages").select("page_id", largest_number("url").alias("number"))


def stream_ingest(spark, folder):
    """Two runs over a growing landing folder; the second takes only the new files."""
    path, store, checkpoint = (new_folder(spark, n) for n in ("landing", "store", "stream"))
    events = load(spark, folder, "events")
    text = _payload(F.col("event_type") == "error")
    for part in (F.col("event_type") == "click", F.col("event_type") != "click"):
        events.where(part).select(text).write.mode("append").text(path)
        start_ingest(spark, path, EVENT, store, checkpoint).awaitTermination()
    return landing.read_store(spark, store)


def _arrays(spark, folder):
    """Landing lines that hold arrays of four events; the values of errors are texts, not numbers."""
    path = new_folder(spark, "landing")
    text = row_as_json("event_id", "event_type", "value")
    unfit = F.regexp_replace(text, '"value":.*}', '"value":"none"}')
    events = load(spark, folder, "events").withColumn(
        "text", F.when(F.col("event_type") == "error", unfit).otherwise(text)
    )
    line = events.groupBy(F.floor(F.col("event_id") / 4)).agg(F.sort_array(F.collect_list("text")).alias("t"))
    line.select(F.concat(F.lit("["), F.concat_ws(", ", "t"), F.lit("]"))).write.text(path)
    return path


def json_array_salvage(spark, folder):
    """Good elements beside bad ones in one array."""
    store = new_folder(spark, "store")
    landing.compact(spark, _arrays(spark, folder), EVENT, store)
    return landing.read_store(spark, store, EVENT)


def json_array_quarantine(spark, folder):
    store = new_folder(spark, "store")
    landing.compact(spark, _arrays(spark, folder), EVENT, store)
    return landing.read_quarantine(spark, store)


def json_large_array(spark, folder):
    """All events as one array in one line of one file, read in splits as files are that are larger than one task's share."""
    path, store = new_folder(spark, "landing"), new_folder(spark, "store")
    events = load(spark, folder, "events")
    first = events.agg(F.min("event_id")).first()[0]
    text = F.concat(F.when(F.col("event_id") == first, "[").otherwise(""), row_as_json("event_id", "event_type", "value"))
    # Test data in one file: every record ends with a comma instead of a line feed, so the array is cut off.
    events.coalesce(1).sortWithinPartitions("event_id").select(text).write.option("lineSep", ",").text(path)
    landing.stored(read_payloads(spark, path, whole=0), EVENT, store)
    return landing.read_store(spark, store, EVENT)


def _cut_arrays(spark, folder):
    """Lines that hold arrays of four events and end before the last one does."""
    path = new_folder(spark, "landing")
    events = load(spark, folder, "events").withColumn("text", row_as_json("event_id", "event_type", "value"))
    line = events.groupBy(F.floor(F.col("event_id") / 4)).agg(F.sort_array(F.collect_list("text")).alias("t"))
    line = line.select(F.concat(F.lit("["), F.concat_ws(" , ", "t")).alias("line"))
    line.select(F.expr("left(line, length(line) - 2)")).write.text(path)
    return path


def json_cut_array(spark, folder):
    """Elements before the end of cut-off arrays."""
    store = new_folder(spark, "store")
    landing.compact(spark, _cut_arrays(spark, folder), EVENT, store)
    return landing.read_store(spark, store, EVENT)


def json_cut_array_quarantine(spark, folder):
    """What is left of the last elements of cut-off arrays, as it is written."""
    return landing.bad_payloads(landing.scan_json(spark, _cut_arrays(spark, folder), EVENT))


def repeated_load(spark, folder):
    """A load whose watermark was lost is repeated later, up to a later day, with more files."""
    paths = RunPaths(new_folder(spark, "workflow"), "run")
    events = load(spark, folder, "events")
    start, stop = _span(events, "ts")
    text = _payload(F.col("event_type") == "error")
    events.where(F.col("event_type") != "click").select(text).write.text(paths.landing)
    landing.compact(spark, paths.landing, EVENT, paths.feature_store, load=f"from-{start}")
    events.where(F.col("event_type") == "click").select(text).write.mode("append").text(paths.landing)
    return flow.ingest(spark, EVENT, LoadSpan(start, stop), paths)


def mixed_store(spark, folder):
    """A stream, then a batch job, into one store."""
    first, second, store, checkpoint = (new_folder(spark, n) for n in ("landing", "landing", "store", "stream"))
    events = load(spark, folder, "events")
    for part, path in ((F.col("event_type") == "click", first), (F.col("event_type") != "click", second)):
        events.where(part).select(_payload(F.lit(False))).write.text(path)
    start_ingest(spark, first, EVENT, store, checkpoint).awaitTermination()
    landing.compact(spark, second, EVENT, store)
    return landing.read_store(spark, store)


def stream_ingest_enveloped(spark, folder):
    store, checkpoint = new_folder(spark, "store"), new_folder(spark, "stream")
    start_ingest(spark, _enveloped(spark, folder), EVENT, store, checkpoint, enveloped=True).awaitTermination()
    return landing.read_store(spark, store)


def restarted_stream(spark, folder):
    """A stream whose checkpoint was lost: old files are not taken again, old rows stay, new files come."""
    path, store, checkpoint = (new_folder(spark, n) for n in ("landing", "store", "stream"))
    events = load(spark, folder, "events")
    for part in (F.col("event_type") == "click", F.col("event_type") != "click"):
        events.where(part).select(_payload(F.lit(False))).write.mode("append").text(path)
        start_ingest(spark, path, EVENT, store, checkpoint).awaitTermination()
        files.delete(spark, checkpoint)
    return landing.read_store(spark, store)


def emptied_load(spark, folder):
    """Two loads, of which one is repeated on a landing folder that holds nothing any more."""
    paths, store = [new_folder(spark, "landing") for _ in range(2)], new_folder(spark, "store")
    events = load(spark, folder, "events")
    for name, part, path in zip("ab", (F.col("event_type") == "click", F.col("event_type") != "click"), paths, strict=True):
        events.where(part).select(_payload(F.lit(False))).write.text(path)
        landing.compact(spark, path, EVENT, store, name)
    files.delete(spark, paths[0])
    landing.compact(spark, paths[0], EVENT, store, "a")
    return landing.read_store(spark, store)


def load_ledger(spark, folder):
    """What the ledger of a store says: one load a type of event, the errors cut off, one load repeated."""
    store = new_folder(spark, "store")
    events = load(spark, folder, "events")
    for kind in ("click", "error", "purchase", "click"):
        path = new_folder(spark, "landing")
        events.where(F.col("event_type") == kind).select(_payload(F.col("event_type") == "error")).write.text(path)
        landing.compact(spark, path, EVENT, store, kind)
    return Loads(spark, store).report().select("name", "rows", "good")


QUERIES = {
    "restarted_stream": restarted_stream,
    "emptied_load": emptied_load,
    "load_ledger": load_ledger,
    "interval_spine_weeks": interval_spine_weeks,
    "interval_spine_years": interval_spine_years,
    "rows_per_week": rows_per_week,
    "rows_per_month": rows_per_month,
    "rows_per_year": rows_per_year,
    "window_requests": window_requests,
    "incremental_slice": incremental_slice,
    "json_scan": json_scan,
    "json_scan_inferred": json_scan_inferred,
    "json_quarantine": json_quarantine,
    "json_good_rows": json_good_rows,
    "json_compaction": json_compaction,
    "json_compaction_quarantine": json_compaction_quarantine,
    "json_envelope_unwrap": json_envelope_unwrap,
    "json_envelope_compaction": json_envelope_compaction,
    "json_column": json_column,
    "rows_as_json": rows_as_json,
    "largest_number_in_url": largest_number_in_url,
    "stream_ingest": stream_ingest,
    "stream_ingest_enveloped": stream_ingest_enveloped,
    "json_array_salvage": json_array_salvage,
    "json_array_quarantine": json_array_quarantine,
    "json_large_array": json_large_array,
    "json_cut_array": json_cut_array,
    "json_cut_array_quarantine": json_cut_array_quarantine,
    "repeated_load": repeated_load,
    "mixed_store": mixed_store,
}


def _spine_sql(bounds: str, cut: str) -> str:
    """Windows of a span given by ``bounds`` (first, stop), cut on days meeting ``cut``."""
    return f"""bounds AS ({bounds}),
    days AS (SELECT unnest(generate_series(first, stop, INTERVAL 1 DAY))::DATE AS d, first, stop FROM bounds),
    cuts AS (SELECT d FROM days WHERE d = first OR d = stop OR {cut}),
    spine AS (SELECT * FROM (SELECT d AS window_start, lead(d) OVER (ORDER BY d) AS window_end FROM cuts)
              WHERE window_end IS NOT NULL)"""


def _bounds(table: str, moment: str) -> str:
    return f"SELECT min({moment})::DATE AS first, (max({moment})::DATE + INTERVAL 1 DAY)::DATE AS stop FROM {table}"


_WEEKS = _spine_sql(_bounds("events", "ts"), "dayofweek(d) = 0")
_YEARS = _spine_sql(_bounds("orders", "o_orderdate"), "strftime(d, '%m-%d') = '12-31'")
_MONTHS = _spine_sql(_bounds("lineitem", "l_shipdate"), "d = last_day(d)")


def _per_window(spine: str, table: str, moment: str) -> str:
    return f"""WITH {spine} SELECT window_start, window_end, count({moment}) AS n_rows
        FROM spine LEFT JOIN {table} ON {moment} >= window_start AND {moment} < window_end GROUP BY 1, 2"""


_EVENTS = "SELECT event_id, event_type, value FROM events"
_BROKEN = """SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","value":' || value
    AS payload, 'Payload is not valid JSON' AS error_msg FROM events WHERE event_type = 'error'"""

_TEXTS = """texts AS (SELECT event_id, event_type, value, event_id // 4 AS line, '{"event_id":' || event_id ||
    ',"event_type":"' || event_type || '","value":' || value || '}' AS text FROM events)"""

ORACLES = {
    "json_large_array": _EVENTS,
    "json_cut_array": f"""WITH {_TEXTS} SELECT event_id, event_type, value FROM texts
        WHERE text <> (SELECT max(text) FROM texts t WHERE t.line = texts.line)""",
    "json_cut_array_quarantine": f"""WITH {_TEXTS} SELECT left(max(text), length(max(text)) - 2) AS payload,
        'Payload is not valid JSON' AS error_msg FROM texts GROUP BY line""",
    "interval_spine_weeks": f"WITH {_WEEKS} SELECT * FROM spine",
    "interval_spine_years": f"WITH {_YEARS} SELECT * FROM spine",
    "rows_per_week": _per_window(_WEEKS, "events", "ts"),
    "rows_per_month": _per_window(_MONTHS, "lineitem", "l_shipdate"),
    "rows_per_year": _per_window(_YEARS, "orders", "o_orderdate"),
    "window_requests": f"""WITH {_WEEKS} SELECT '/events?before=' || window_end ||
        '&from=' || window_start || '&format=json' AS request FROM spine""",
    "incremental_slice": f"""WITH bounds AS ({_bounds("events", "ts")})
        SELECT event_id, event_type, value FROM events, bounds
        WHERE ts >= first + INTERVAL 1 DAY * ((stop - first) // 2) AND ts < stop""",
    "json_scan": _EVENTS,
    "json_scan_inferred": _EVENTS,
    "json_quarantine": _BROKEN,
    "json_good_rows": f"{_EVENTS} WHERE event_type <> 'error'",
    "json_compaction": f"{_EVENTS} WHERE event_type <> 'error'",
    "json_compaction_quarantine": _BROKEN,
    "json_envelope_unwrap": f"{_EVENTS} WHERE event_type <> 'view'",
    "json_envelope_compaction": f"{_EVENTS} WHERE event_type <> 'view'",
    "json_column": """SELECT event_id,
        CASE WHEN event_type <> 'error' THEN (props::JSON->>'k')::BIGINT END AS k,
        event_type <> 'error' AS payload_ok FROM events""",
    "rows_as_json": """SELECT event_id,
        to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type})::VARCHAR AS row_json
        FROM events""",
    "largest_number_in_url": r"""SELECT page_id,
        list_max(list_transform(regexp_extract_all(url, '\d+'), lambda d: d::BIGINT)) AS number FROM pages""",
    "stream_ingest": f"{_EVENTS} WHERE event_type <> 'error'",
    "stream_ingest_enveloped": f"{_EVENTS} WHERE event_type <> 'view'",
    "json_array_salvage": f"{_EVENTS} WHERE event_type <> 'error'",
    "json_array_quarantine": """SELECT '{"event_id":' || event_id || ',"event_type":"error","value":"none"}' AS payload,
        'Payload does not fit the record' AS error_msg FROM events WHERE event_type = 'error'""",
    "repeated_load": f"{_EVENTS} WHERE event_type <> 'error'",
    "mixed_store": _EVENTS,
    "restarted_stream": _EVENTS,
    "emptied_load": f"{_EVENTS} WHERE event_type <> 'click'",
    "load_ledger": """SELECT event_type AS name, count(*) AS rows, count(*) FILTER (event_type <> 'error') AS good
        FROM events WHERE event_type IN ('click', 'error', 'purchase') GROUP BY 1""",
}
