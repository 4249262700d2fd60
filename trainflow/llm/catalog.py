"""The operators on their whole tables, with the columns that their queries return."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trainflow.catalog.tables import load
from trainflow.llm import (
    conversations,
    decontaminate,
    divergence,
    licenses,
    line_dedup,
    multi_index,
    order_minhash,
    packing,
    quality,
    records,
    secrets,
    simhash,
    substrings,
)


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    machine = quality.train(docs, load(spark, folder, "labels"))
    score = quality.scored(docs.select("doc_id", "text", "n_chars"), machine)
    return score.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    base = [r.kind for r in secrets.BASE]
    docs = secrets.with_spans(load(spark, folder, "documents").select("doc_id", "text"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base_spans = F.filter("spans", lambda s: s["kind"].isin(base))
    return docs.select(
        "doc_id",
        *(count(kind) for kind in base),
        F.sha2(joined(base_spans), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, folder, "documents"), "doc_id", "text", shingle=3, max_bits=3)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def byte_bpe() -> str:
    """The vocabulary of the token queries, as the tokenizers library writes it."""
    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")


def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = order_minhash.fingerprints(load(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        order_minhash.as_text(F.col("slots")).alias("fingerprint"),
        order_minhash.as_text(F.col("edited_slots")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op5_token_records(spark: SparkSession, folder: str) -> DataFrame:
    return records.round_trip(spark, load(spark, folder, "documents"), byte_bpe(), end=0, as_text=False)


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's licences: how many finds, the best covered name, and all of them with their places."""
    docs = licenses.with_licenses(load(spark, folder, "documents").select("doc_id", "text"))
    finds = F.transform("licenses", lambda s: F.concat_ws(":", s["name"], s["start"], s["end"]))
    order = F.transform("licenses", lambda s: F.struct(-s["coverage"], s["start"], s["name"].alias("name"), s["coverage"].alias("coverage")))
    best = F.get(F.array_sort(order), F.lit(0))
    return docs.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        best["name"].alias("license"),
        F.coalesce(best["coverage"], F.lit(0.0)).alias("coverage"),
        F.array_join(finds, ",").alias("licenses"),
    )


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(load(spark, folder, "documents"), byte_bpe(), end=2, size=1024, as_text=False)


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


OP8_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(13, len(w)) AS size,
           array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS words
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT size FROM windows
), spots AS (
    SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), hits AS (
    SELECT doc_id, i, spots.size, item FROM spots JOIN windows USING (words)
    WHERE spots.size = windows.size
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits))
    GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.without_repeats(load(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), firsts AS (
    SELECT words, min(doc_id) AS first FROM windows GROUP BY words
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
    FROM windows JOIN firsts USING (words) WHERE doc_id > first
), places AS (
    SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n_kept
    FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.deduplicated(load(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = load(spark, folder, "conversations")
    edits = conversations.edits(conversations.damaged(turns), "conv", "turn", "role", "text")
    found = conversations.digests(edits)
    every = turns.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *(F.coalesce(F.col("report")[c], F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.nearest(load(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(load(spark, folder, "documents"))


OP13_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), cells AS (
    SELECT doc, lang, source, term, count(*) AS n
    FROM (SELECT doc, lang, source, unnest(w) AS term FROM d) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n) AS n_lang FROM cells GROUP BY lang, term HAVING count(*) >= 30
), groups AS (
    SELECT DISTINCT lang, source FROM d
), counts AS (
    SELECT lang, source, term, sum(n) AS n FROM cells GROUP BY ALL
), dense AS (
    SELECT g.lang, g.source, k.term, k.n_lang, coalesce(c.n, 0)::HUGEINT AS n
    FROM groups g JOIN kept k ON k.lang = g.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
    SELECT lang, source, term, n,
           1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER s + 5 * count(*) OVER s) AS p,
           1 + (1000000000::HUGEINT * (n_lang + 5)) // (sum(n_lang) OVER s + 5 * count(*) OVER s) AS q
    FROM dense WINDOW s AS (PARTITION BY lang, source)
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    UNION ALL
    SELECT a.lang, a.source, 'pair', b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    WHERE a.lang NOT IN (SELECT lang FROM kept)
), items AS (
    SELECT * FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
)
SELECT * FROM (
    SELECT lang, source, part, item, value::BIGINT AS value,
           (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
    FROM items
) WHERE part = 'pair' OR rank <= 50
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op10_line_dedup": op10_line_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op4_order_minhash": op4_order_minhash,
    "op5_token_records": op5_token_records,
    "op6_license_scan": op6_license_scan,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op1_quality_classifier": op1_quality_classifier,
    "op2_secret_scan": op2_secret_scan,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_nearest_vectors": op12_nearest_vectors,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES: dict[str, str] = {
    "op8_benchmark_decontamination": OP8_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op13_source_divergence": OP13_SQL,
}
