"""Bag of words: terms, document frequency, TF-IDF, hashed term counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainflow.functions import hash_bucket, tokens
from trainflow.operators import lookup as lookups
from trainflow.operators.lookup import lookup, table_size
from trainflow.workspace import written


def token_rows(df: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """One row per word of each text, whole texts."""
    return df.select(*key, F.explode(tokens(text)).alias("term"))


def term_counts(df: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """``key, term, tf``: how often each word occurs in each text.

    A text whose key no other row has is counted in its own row, without a shuffle of its words; only texts
    that share a key are counted together.
    """
    rows = df.select(*key, F.col(text).alias("__text"))
    repeated = rows.groupBy(*[F.col(k).alias(f"__r_{k}") for k in key]).agg(F.count(F.lit(1)).alias("__n"))
    repeated = written(repeated.where("__n > 1").drop("__n"), "repeated_keys")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in key])
    together = token_rows(rows.join(repeated, same, "left_semi"), key, "__text")
    together = together.groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"))
    return _counts_in_row(rows.join(repeated, same, "left_anti"), key, "__text").unionByName(together)


def _counts_in_row(df: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """``key, term, tf`` of single texts: words are sorted, and a word's count is the length of its run."""
    words = df.select(*key, F.sort_array(tokens(text)).alias("__w"))
    new = F.transform("__w", lambda w, i: F.when((i == 0) | (w != F.get("__w", i - 1)), i))
    starts = words.select(*key, "__w", F.array_compact(new).alias("__s"))
    end = lambda i: F.coalesce(F.get("__s", i + 1), F.size("__w"))
    runs = F.transform("__s", lambda s, i: F.struct(F.get("__w", s).alias("term"), (end(i) - s).cast("long").alias("tf")))
    return starts.select(*key, F.explode(runs).alias("__run")).select(*key, "__run.term", "__run.tf")


def document_frequency(df: DataFrame, text: str) -> DataFrame:
    """``term, df``: number of texts holding each word. Each text counts once by itself."""
    words = df.select(F.explode(F.array_distinct(tokens(text))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def counted_frequency(counts: DataFrame) -> DataFrame:
    """The same from term counts, without splitting the texts again."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def inverse_frequency(documents: int, df: Column, min_doc_freq: int = 0) -> Column:
    """``ln((documents + 1) / (df + 1))``; 0 for words in fewer than ``min_doc_freq`` texts."""
    weight = F.log((F.lit(float(documents)) + 1.0) / (df.cast("double") + 1.0))
    return F.when(df >= min_doc_freq, weight).otherwise(F.lit(0.0))


def tf_idf(counts: DataFrame, key: Sequence[str], frequency: DataFrame, documents: int) -> DataFrame:
    """``key, term, tfidf`` over the exact vocabulary; words outside ``frequency`` are left out.

    ``counts`` are the term counts of the texts, ``frequency`` that of the ``documents`` learnt from.
    """
    counted = _with_frequency(counts, key, frequency)
    weight = F.col("tf").cast("double") * inverse_frequency(documents, F.col("df"))
    return counted.select(*key, "term", weight.alias("tfidf"))


def _with_frequency(counts: DataFrame, key: Sequence[str], frequency: DataFrame) -> DataFrame:
    """``key, term, tf, df`` of the words that are in ``frequency``.

    A vocabulary too large to broadcast is parted: its most frequent words, which most rows have, are
    broadcast, and only the rows of the others are shuffled.
    """
    rows = counts.select(*key, "term", "tf")
    size = table_size(frequency, "term", "df")
    if size.small:
        return lookup(rows, F.col("term"), frequency, "term", {"df": "df"}, "inner", size)
    head = _most_frequent(frequency)
    found = rows.join(F.broadcast(head.select(F.col("term").alias("__term"), "df")), F.col("term") == F.col("__term"), "left")
    often = found.where(F.col("__term").isNotNull()).select(*key, "term", "tf", "df")
    rare = found.where(F.col("__term").isNull()).select(*key, "term", "tf")
    others = frequency.join(F.broadcast(head.select("term")), "term", "left_anti")
    return often.unionByName(lookup(rare, F.col("term"), others, "term", {"df": "df"}, "inner"))


def _most_frequent(frequency: DataFrame) -> DataFrame:
    """Words in more texts than all others, as many as a broadcast may have."""
    width = F.octet_length("term") + F.lit(8)
    sizes = frequency.groupBy("df").agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b"))
    order = Window.orderBy(F.desc("df"))
    # One row per number of texts: fewer than the square root of twice the sum of them.
    upto = sizes.select("df", F.sum("n").over(order).alias("n"), F.sum("b").over(order).alias("b"))
    fits = upto.where((F.col("n") <= lookups.BROADCAST_ROWS) & (F.col("b") <= lookups.BROADCAST_BYTES))
    least = fits.agg(F.min("df")).first()[0]
    return written(frequency.where(F.lit(False) if least is None else F.col("df") >= least).select("term", "df"), "frequent_terms")


def hashed_terms(df: DataFrame, key: Sequence[str], text: str, slots: int) -> DataFrame:
    """``key, slot, tf``: word counts folded into a fixed number of slots by digest."""
    words = token_rows(df, key, text).withColumn("slot", hash_bucket(F.col("term"), slots))
    return words.groupBy(*key, "slot").agg(F.count(F.lit(1)).alias("tf"))
