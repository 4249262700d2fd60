"""Elapsed days, imputation, scaling and splitting, as expressions and as pipeline stages."""

from __future__ import annotations

from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trainflow.catalog.tables import CASES, cases, load
from trainflow.functions import elapsed_days as days_between
from trainflow.operators import frequency, scaling, splits
from trainflow.operators.stages import ConstantFiller, ElapsedDays, ModeImputer
from trainflow.spec import TEST_PERCENT
from trainflow.workspace import written

CATEGORIES = ["priority", "segment", "channel"]
MODES = [f"im_{c}" for c in CATEGORIES]


def elapsed_days(spark, folder):
    days = days_between("sent_at", "opened_at")
    return cases(spark, folder).select("case_id", F.round(days, 6).alias("diff_in_days"))


def elapsed_days_stage(spark, folder):
    stage = ElapsedDays(inputCols=["sent_at", "opened_at"], outputCols=["diff_in_days"])
    days = stage.transform(cases(spark, folder))
    return days.select("case_id", F.round("diff_in_days", 6).alias("diff_in_days"))


def elapsed_days_from_text(spark, folder):
    """Dates as text, with one status written in a form that does not parse."""
    text = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    orders = load(spark, folder, "orders").select("o_orderkey", text.alias("opened_at"))
    days = days_between(F.lit("1995-01-01 12:00:00"), "opened_at")
    return orders.select("o_orderkey", F.round(days, 6).alias("diff_in_days"))


def _with_days(spark, folder):
    """Stored, as fitting and filling both read it."""
    days = days_between("sent_at", "opened_at").alias("diff_in_days")
    return written(cases(spark, folder).select("case_id", days), "days")


def _categories(spark, folder):
    return written(cases(spark, folder).select("case_id", *CATEGORIES), "categories")


def mean_impute(spark, folder):
    df = _with_days(spark, folder)
    filled = frequency.fill_means(df, frequency.means(df, ["diff_in_days"]))
    return filled.select("case_id", F.round("im_diff_in_days", 6).alias("im_diff_in_days"))


def mean_impute_stage(spark, folder):
    df = _with_days(spark, folder)
    imputer = Imputer(strategy="mean", inputCols=["diff_in_days"], outputCols=["im_diff_in_days"])
    return imputer.fit(df).transform(df).select("case_id", F.round("im_diff_in_days", 6).alias("im_diff_in_days"))


def mode_impute(spark, folder):
    df = _categories(spark, folder)
    filled = frequency.fill_with(df, frequency.mode_values(df, CATEGORIES))
    return filled.select("case_id", *MODES)


def mode_impute_stage(spark, folder):
    df = _categories(spark, folder)
    return ModeImputer(inputCols=CATEGORIES, outputCols=MODES).fit(df).transform(df).select("case_id", *MODES)


def constant_fill(spark, folder):
    filler = ConstantFiller(inputCols=["subject"], outputCols=["subject_text"], values=["(none)"])
    return filler.transform(cases(spark, folder)).select("case_id", "subject_text")


def standard_scale(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    scaled = scaling.scale(orders, scaling.deviations(orders, ["o_totalprice"]))
    return scaled.select("o_orderkey", F.round("scaled_o_totalprice", 6).alias("scaled_price"))


def standard_scale_stage(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    vectors = VectorAssembler(inputCols=["o_totalprice"], outputCol="vector").transform(orders)
    scaler = StandardScaler(inputCol="vector", outputCol="scaled").fit(vectors)
    value = F.round(vector_to_array("scaled")[0], 6).alias("scaled_price")
    return scaler.transform(vectors).select("o_orderkey", value)


def hash_split(spark, folder):
    orders = load(spark, folder, "orders")
    return splits.with_split(orders, ["o_orderkey"], TEST_PERCENT).select("o_orderkey", "split")


def split_balance(spark, folder):
    marked = splits.with_split(cases(spark, folder), ["case_id"], TEST_PERCENT)
    balance = splits.split_balance(marked, "split", "outcome")
    return balance.withColumn("share", F.round("share", 6))


def key_sample(spark, folder):
    items = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return splits.key_sample(items, "o_orderkey", 1_000)


QUERIES = {
    "elapsed_days": elapsed_days,
    "elapsed_days_stage": elapsed_days_stage,
    "elapsed_days_from_text": elapsed_days_from_text,
    "mean_impute": mean_impute,
    "mean_impute_stage": mean_impute_stage,
    "mode_impute": mode_impute,
    "mode_impute_stage": mode_impute_stage,
    "constant_fill": constant_fill,
    "standard_scale": standard_scale,
    "standard_scale_stage": standard_scale_stage,
    "hash_split": hash_split,
    "split_balance": split_balance,
    "key_sample": key_sample,
}


def _days(start: str, end: str) -> str:
    return f"abs(floor(epoch({end}))::BIGINT - floor(epoch({start}))::BIGINT) / 86400.0::DOUBLE"


def digest(key: str, buckets: int) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR), 1, 8))::BIGINT % {buckets})"


_MODE = "(SELECT {c} FROM cases WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
_ELAPSED = f"SELECT case_id, round({_days('sent_at', 'opened_at')}, 6) AS diff_in_days FROM cases"
_MEAN = f"""WITH {CASES}, d AS (SELECT case_id, {_days('sent_at', 'opened_at')} AS x FROM cases)
    SELECT case_id, round(coalesce(x, (SELECT avg(x) FROM d)), 6) AS im_diff_in_days FROM d"""
_MODES = (
    f"WITH {CASES} SELECT case_id, "
    + ", ".join(f"coalesce({c}, {_MODE.format(c=c)}) AS im_{c}" for c in CATEGORIES)
    + " FROM cases"
)
_SCALED = """SELECT o_orderkey,
    round(o_totalprice / (SELECT stddev_samp(o_totalprice) FROM orders), 6) AS scaled_price FROM orders"""
_SPLIT = f"CASE WHEN {{}} < {100 - TEST_PERCENT} THEN 'train' ELSE 'test' END"

ORACLES = {
    "elapsed_days": f"WITH {CASES} {_ELAPSED}",
    "elapsed_days_stage": f"WITH {CASES} {_ELAPSED}",
    "elapsed_days_from_text": f"""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN
        round({_days("TIMESTAMP '1995-01-01 12:00:00'", "o_orderdate")}, 6) END AS diff_in_days FROM orders""",
    "mean_impute": _MEAN,
    "mean_impute_stage": _MEAN,
    "mode_impute": _MODES,
    "mode_impute_stage": _MODES,
    "constant_fill": f"WITH {CASES} SELECT case_id, coalesce(subject, '(none)') AS subject_text FROM cases",
    "standard_scale": _SCALED,
    "standard_scale_stage": _SCALED,
    "hash_split": f"SELECT o_orderkey, {_SPLIT.format(digest('o_orderkey', 100))} AS split FROM orders",
    "split_balance": f"""WITH {CASES}, c AS (
        SELECT {_SPLIT.format(digest('case_id', 100))} AS split, outcome, count(*) AS cnt FROM cases GROUP BY 1, 2)
        SELECT split, outcome, cnt, (sum(cnt) OVER (PARTITION BY split))::BIGINT AS part_row,
               round(cnt::DOUBLE / sum(cnt) OVER (PARTITION BY split), 6) AS share FROM c""",
    "key_sample": f"SELECT o_orderkey, o_totalprice FROM orders WHERE {digest('o_orderkey', 1000000)} < 1000",
}
