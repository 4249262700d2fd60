"""Tables on disk: append, overwrite, drifting columns, record history and model versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from trainflow.catalog.tables import CASE_COLUMNS, CASE_SPEC, CASES, cases, load, per_column
from trainflow.functions import path_version, to_timestamp
from trainflow.operators import history
from trainflow.plans.evaluation import EvaluationLog
from trainflow.sources import inventory, tables
from trainflow.sources.ledger import Loads
from trainflow.sources.statistics import SKETCH, LoadStatistics
from trainflow.workspace import new_folder, written

ORDER = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def _orders(spark, folder, *more):
    return load(spark, folder, "orders").select(*ORDER, *more)


def parquet_append(spark, folder):
    """Three loads, one per status, appended to one table."""
    path = new_folder(spark, "orders")
    orders = _orders(spark, folder)
    for status in ("F", "O", "P"):
        tables.append(orders.where(F.col("o_orderstatus") == status), path)
    return tables.read_table(spark, path)


def parquet_create(spark, folder):
    path = new_folder(spark, "orders")
    tables.create(_orders(spark, folder), path)
    return tables.read_table(spark, path)


def parquet_overwrite(spark, folder):
    path = new_folder(spark, "orders")
    orders = _orders(spark, folder)
    tables.replace(orders, path)
    tables.replace(orders.withColumn("o_totalprice", F.lit(0.0)), path)
    return tables.read_table(spark, path)


def parquet_partition_overwrite(spark, folder):
    """A rerun of one partition leaves the others alone."""
    path = new_folder(spark, "orders")
    orders = _orders(spark, folder)
    tables.replace(orders, path, ["o_orderstatus"])
    rerun = orders.where(F.col("o_orderstatus") == "P").withColumn("o_totalprice", F.lit(0.0))
    tables.replace(rerun, path, ["o_orderstatus"])
    return tables.read_table(spark, path)


def schema_merge_read(spark, folder):
    """The second load brings a column the first did not have."""
    path = new_folder(spark, "orders")
    orders = _orders(spark, folder, "o_orderpriority")
    tables.append(orders.where(F.col("o_orderstatus") == "F").drop("o_orderpriority"), path)
    tables.append(orders.where(F.col("o_orderstatus") != "F"), path)
    return tables.read_table(spark, path, merge=True)


def file_inventory(spark, folder):
    return inventory.file_inventory(spark, folder, "parquet")


def table_files(spark, folder):
    """The inventory by table: a table is one file or a folder of them."""
    name = F.regexp_extract("path", r"/([a-z]+)\.parquet(/[^/]+)?$", 1)
    found = inventory.file_inventory(spark, folder, "parquet").where("length > 0")
    return found.select(name.alias("name")).distinct()


def _records(spark, folder):
    """A log of evaluation records made from the events; purchases are accepted models."""
    path = new_folder(spark, "evaluations")
    accepted = (F.col("event_type") == "purchase").alias("model_accepted")
    rows = load(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        accepted,
        F.col("value").cast("double").alias("changed_accuracy"),
        F.lit("trained").alias("trained_model_path"),
        F.lit(None).cast("string").alias("best_model_path"),
        accepted.alias("active"),
        F.to_timestamp(F.lit("2020-01-01")).alias("created_timestamp"),
        F.lit(False).alias("deleted"),
    )
    tables.append(rows, path)
    return EvaluationLog(spark, path)


def records_update(spark, folder):
    """All accepted models of little gain are put out of use."""
    log = _records(spark, folder)
    log.update(F.col("model_accepted") & (F.col("changed_accuracy") < 50), active=False)
    return log.records().select("run_id", "active")


def records_delete_many(spark, folder):
    log = _records(spark, folder)
    log.delete(~F.col("model_accepted"))
    return log.records().select("run_id", "active")


def records_delete_one(spark, folder):
    """Of the matching records, all of one age, the first by run goes."""
    log = _records(spark, folder)
    log.delete_one(F.col("model_accepted"))
    return log.records().select("run_id", "active")


def input_report(spark, folder):
    paths = [f"{folder.rstrip('/')}/{name}.parquet" for name in ("orders", "lineitem", "customer")]
    checked = inventory.check_inputs(spark, paths, ["o_orderkey", "o_orderpriority"])
    rows = inventory.rows_per_file(tables.read_table(spark, *inventory.split_inputs(checked)[0]))
    report = inventory.input_report(spark, checked).withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1))
    counted = rows.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "n_rows")
    return report.join(counted, "file", "left").select("file", "valid", "n_rows")


def _log(spark, folder):
    """Events as a record log: users are the records, an error deletes its user's record."""
    return load(spark, folder, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("version"),
        "event_type",
        "value",
        (F.col("event_type") == "error").alias("deleted"),
    )


def evaluation_history(spark, folder):
    return history.current(_log(spark, folder), ["run_id"], "version", "deleted")


def evaluation_find(spark, folder):
    query = (F.col("event_type") == "purchase") & (F.col("value") >= 5)
    return history.find(_log(spark, folder), ["run_id"], "version", "deleted", query)


def _model_paths(spark, folder):
    """Events as saved models: the type is the model key, the second the version."""
    second = F.unix_seconds(to_timestamp("ts")).cast("string")
    path = F.concat_ws("/", F.lit("registry-2"), "event_type", F.lit("saved_models"), second, F.lit("model"))
    return load(spark, folder, "events").select(
        F.col("event_type").alias("model_key"), "event_id", path.alias("path")
    )


def newest_model_version(spark, folder):
    models = _model_paths(spark, folder).withColumn("version", path_version("path"))
    return history.newest(models, ["model_key"], ["version", "event_id"])


def model_versions(spark, folder):
    models = _model_paths(spark, folder).withColumn("version", path_version("path"))
    return models.groupBy("model_key").agg(F.count_distinct("version").alias("n_versions"))


def declared_schema(spark, folder):
    """Case columns read with the schema their roles declare: dates arrive as timestamps."""
    path = new_folder(spark, "cases")
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("case_id"),
        F.col("o_orderstatus").alias("outcome"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("opened_at"),
    )
    orders.write.json(path)
    read = spark.read.schema(CASE_SPEC.schema()).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").json(path)
    return read.select(
        F.col("case_id").cast("long").alias("case_id"), "outcome", F.unix_seconds("opened_at").alias("opened_second")
    )


def _case_loads(spark, folder):
    """Case records in one load per outcome, one of which is loaded wrongly at first and then again."""
    rows = written(cases(spark, folder), "cases")
    store = new_folder(spark, "loads")
    loads, kept = Loads(spark, store), LoadStatistics(spark, store)
    for name, outcome in (("a", "Yes"), ("b", "No"), ("b", "N/A"), ("c", "No")):
        loads.write(rows.where(F.col("outcome") == outcome), name=name)
        kept.update()
    return kept


def profile_of_loads(spark, folder):
    """The profile put together from the states of the loads; distinct values where they are counted exactly."""
    return _case_loads(spark, folder).profile().select(
        "column",
        F.when(F.col("exact"), F.col("n_unique")).alias("n_unique"),
        "n_missing",
        F.round("missing_percentage", 6).alias("missing_percentage"),
        "exact",
    )


def numbers_of_loads(spark, folder):
    found = _case_loads(spark, folder).numbers()
    return found.select("column", "n", *[F.round(c, 4).alias(c) for c in ("mean", "deviation")])


QUERIES = {
    "parquet_append": parquet_append,
    "parquet_create": parquet_create,
    "parquet_overwrite": parquet_overwrite,
    "parquet_partition_overwrite": parquet_partition_overwrite,
    "schema_merge_read": schema_merge_read,
    "file_inventory": file_inventory,
    "input_report": input_report,
    "table_files": table_files,
    "records_update": records_update,
    "records_delete_many": records_delete_many,
    "records_delete_one": records_delete_one,
    "evaluation_history": evaluation_history,
    "evaluation_find": evaluation_find,
    "newest_model_version": newest_model_version,
    "model_versions": model_versions,
    "declared_schema": declared_schema,
    "profile_of_loads": profile_of_loads,
    "numbers_of_loads": numbers_of_loads,
}

_ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
_CURRENT = """SELECT run_id, version, event_type, value FROM (
    SELECT user_id AS run_id, event_id AS version, event_type, value,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events)
    WHERE place = 1 AND event_type <> 'error'"""
_SECOND = "floor(epoch(ts))::BIGINT"

ORACLES = {
    "parquet_append": _ORDERS,
    "parquet_create": _ORDERS,
    "parquet_overwrite": "SELECT o_orderkey, o_orderstatus, 0.0::DOUBLE AS o_totalprice FROM orders",
    "parquet_partition_overwrite": """SELECT o_orderkey, o_orderstatus,
        CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders""",
    "schema_merge_read": """SELECT o_orderkey, o_orderstatus, o_totalprice,
        CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "table_files": """SELECT unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events',
        'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations']) AS name""",
    "records_update": """SELECT event_id::VARCHAR AS run_id, event_type = 'purchase' AND value >= 50 AS active FROM events""",
    "records_delete_many": """SELECT event_id::VARCHAR AS run_id, true AS active FROM events
        WHERE event_type = 'purchase'""",
    "records_delete_one": """SELECT event_id::VARCHAR AS run_id, event_type = 'purchase' AS active FROM events
        WHERE event_id::VARCHAR <> (SELECT min(event_id::VARCHAR) FROM events WHERE event_type = 'purchase')""",
    "input_report": """SELECT 'orders.parquet' AS file, true AS valid, count(*) AS n_rows FROM orders
        UNION ALL SELECT 'lineitem.parquet', false, NULL UNION ALL SELECT 'customer.parquet', false, NULL""",
    "evaluation_history": _CURRENT,
    "evaluation_find": f"SELECT * FROM ({_CURRENT}) WHERE event_type = 'purchase' AND value >= 5",
    "newest_model_version": f"""SELECT model_key, event_id, path, version FROM (
        SELECT event_type AS model_key, event_id, {_SECOND} AS version,
               'registry-2/' || event_type || '/saved_models/' || {_SECOND} || '/model' AS path,
               row_number() OVER (PARTITION BY event_type ORDER BY {_SECOND} DESC, event_id DESC) AS place
        FROM events) WHERE place = 1""",
    "model_versions": f"""SELECT event_type AS model_key, count(DISTINCT {_SECOND}) AS n_versions
        FROM events GROUP BY 1""",
    "declared_schema": """SELECT o_orderkey AS case_id, o_orderstatus AS outcome,
        floor(epoch(o_orderdate))::BIGINT AS opened_second FROM orders""",
    "profile_of_loads": f"""WITH {CASES} SELECT "column", CASE WHEN n < {(1 << SKETCH) * 7 // 8} THEN n + (n_missing > 0)::INT END
            AS n_unique, n_missing, missing_percentage, n < {(1 << SKETCH) * 7 // 8} AS exact FROM ("""
    + per_column(
        "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n, count(*) - count({c}) AS n_missing, "
        "round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS missing_percentage FROM cases",
        CASE_COLUMNS,
    )
    + ")",
    "numbers_of_loads": f"WITH {CASES} "
    + per_column(
        "SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}::DOUBLE), 4) AS mean, "
        "round(stddev_samp({c}::DOUBLE), 4) AS deviation FROM cases",
        ["case_id", "amount"],
    ),
}
