"""Categories and words as numbers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, OneHotEncoder, StringIndexer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trainflow.catalog.prepare import digest
from trainflow.catalog.tables import CASES, cases, load, per_column
from trainflow.operators import frequency, text
from trainflow.operators.stages import FrequencyEncoder, WideIndexer
from trainflow.spec import TEXT_SLOTS
from trainflow.workspace import written

CATEGORIES = ["priority", "segment", "channel"]


def _documents(spark, folder):
    return load(spark, folder, "documents").select("doc_id", "text")


def category_index(spark, folder):
    return frequency.category_index(frequency.value_counts(cases(spark, folder), CATEGORIES))


def category_index_wide(spark, folder):
    """A column with about as many values as rows: customer names, ranked without one big task."""
    names = load(spark, folder, "customer").select("c_name")
    return frequency.category_index(frequency.value_counts(names, ["c_name"]))


def one_hot_long(spark, folder):
    df = written(cases(spark, folder).select("case_id", *CATEGORIES), "categories")
    index = written(frequency.category_index(frequency.value_counts(df, CATEGORIES)), "index")
    return frequency.one_hot_slots(df, ["case_id"], index, CATEGORIES)


def string_indexer_stage(spark, folder):
    """Nulls, as values unseen, take the slot behind the last."""
    df = written(cases(spark, folder).select("case_id", *CATEGORIES), "categories")
    out = [f"si_{c}" for c in CATEGORIES]
    model = StringIndexer(inputCols=CATEGORIES, outputCols=out, handleInvalid="keep").fit(df)
    return model.transform(df).select("case_id", *[F.col(c).cast("long").alias(c) for c in out])


def one_hot_stage(spark, folder):
    """One-hot vectors of all cases as ``key, slot`` pairs; a null takes the last slot, which is dropped."""
    df = written(cases(spark, folder).select("case_id", "segment"), "segments")
    stages = [
        StringIndexer(inputCol="segment", outputCol="si_segment", handleInvalid="keep"),
        OneHotEncoder(inputCols=["si_segment"], outputCols=["tf_segment"]),
    ]
    encoded = Pipeline(stages=stages).fit(df).transform(df)
    cells = encoded.select("case_id", F.posexplode(vector_to_array("tf_segment")).alias("slot", "bit"))
    return cells.where(F.col("bit") != 0).select("case_id", "slot")


def wide_one_hot_stage(spark, folder):
    """Subjects and case ids, as many as there are rows, indexed and as sparse vectors in Spark's own notation."""
    df = written(cases(spark, folder).select("case_id", "subject"), "subjects")
    index = WideIndexer(inputCols=["subject", "case_id"], outputCols=["si_subject", "si_case"]).fit(df)
    model = PipelineModel(stages=[index, index.one_hot(spark, ["tf_subject", "tf_case"])])
    found = model.transform(df)
    indexes = [F.col(c).cast("long").alias(c) for c in ("si_subject", "si_case")]
    return found.select("case_id", *indexes, *[F.col(c).cast("string").alias(c) for c in ("tf_subject", "tf_case")])


def _frequency_encode(spark, folder, how):
    df = written(cases(spark, folder).select("case_id", "segment"), "segments")
    table = written(frequency.frequency_table(df, "segment", "segment_count"), "frequencies")
    return frequency.frequency_encode(df, "segment", table, "segment_count", how)


def frequency_encode_left(spark, folder):
    """Null segments are counted as a group of their own but match nothing: 0."""
    return _frequency_encode(spark, folder, "left")


def frequency_encode_inner(spark, folder):
    return _frequency_encode(spark, folder, "inner")


def frequency_encode_stage(spark, folder):
    """Several columns at once; the customer key has many values and one count table holds them all."""
    df = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    encoder = FrequencyEncoder(inputCols=["o_custkey", "o_orderpriority"], outputCols=["fe_customer", "fe_priority"])
    return encoder.fit(df).transform(df).select("o_orderkey", "fe_customer", "fe_priority")


def tokens(spark, folder):
    documents = _documents(spark, folder)
    return text.term_counts(documents, ["doc_id"], "text")


def document_frequency(spark, folder):
    return text.document_frequency(_documents(spark, folder), "text")


def idf_weights(spark, folder):
    documents = _documents(spark, folder)
    weight = text.inverse_frequency(documents.count(), F.col("df"))
    return text.document_frequency(documents, "text").select("term", F.round(weight, 6).alias("idf"))


def _tf_idf(documents, key, column):
    """Texts are split once: the term counts are stored, and so are the word weights made from them."""
    counts = written(text.term_counts(documents, [key], column), "counts")
    frequencies = written(text.counted_frequency(counts), "terms")
    weights = text.tf_idf(counts, [key], frequencies, documents.count())
    return weights.withColumn("tfidf", F.round("tfidf", 6))


def tfidf(spark, folder):
    return _tf_idf(_documents(spark, folder), "doc_id", "text")


def tfidf_subjects(spark, folder):
    """Short texts: the words of part names."""
    return _tf_idf(load(spark, folder, "part"), "p_partkey", "p_name")


def hashed_terms_digest(spark, folder):
    return text.hashed_terms(_documents(spark, folder), ["doc_id"], "text", TEXT_SLOTS)


def hashed_tfidf_stage(spark, folder):
    documents = _documents(spark, folder)
    stages = [
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=TEXT_SLOTS),
        IDF(inputCol="rawFeatures", outputCol="tf_text"),
    ]
    model = Pipeline(stages=stages).fit(documents)
    weights = vector_to_array("tf_text").alias("tf_text")
    return model.transform(documents).select("doc_id", F.size("words").alias("n_words"), weights)


def hashed_terms_stage(spark, folder):
    """Words that the hashed counts of each document add up to."""
    stages = [
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=TEXT_SLOTS),
    ]
    documents = _documents(spark, folder)
    counted = Pipeline(stages=stages).fit(documents).transform(documents)
    total = F.aggregate(vector_to_array("rawFeatures"), F.lit(0.0), lambda a, b: a + b)
    return counted.select("doc_id", total.cast("long").alias("n_words"))


def tokenizer_stage(spark, folder):
    """Words of the pipeline's tokenizer; unlike ``tokens`` it keeps blanks between two spaces."""
    documents = _documents(spark, folder)
    words = Tokenizer(inputCol="text", outputCol="words").transform(documents)
    filled = F.size(F.filter("words", lambda w: w != "")).cast("long")
    return words.select("doc_id", filled.alias("n_words"))


QUERIES = {
    "category_index": category_index,
    "category_index_wide": category_index_wide,
    "one_hot_long": one_hot_long,
    "string_indexer_stage": string_indexer_stage,
    "one_hot_stage": one_hot_stage,
    "wide_one_hot_stage": wide_one_hot_stage,
    "frequency_encode_left": frequency_encode_left,
    "frequency_encode_inner": frequency_encode_inner,
    "frequency_encode_stage": frequency_encode_stage,
    "tokens": tokens,
    "document_frequency": document_frequency,
    "idf_weights": idf_weights,
    "tfidf": tfidf,
    "tfidf_subjects": tfidf_subjects,
    "hashed_terms_digest": hashed_terms_digest,
    "hashed_tfidf_stage": hashed_tfidf_stage,
    "tokenizer_stage": tokenizer_stage,
    "hashed_terms_stage": hashed_terms_stage,
}

_INDEX = per_column(
    "SELECT '{c}' AS \"column\", {c} AS value, count(*) AS cnt, "
    "row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx FROM cases WHERE {c} IS NOT NULL GROUP BY {c}",
    CATEGORIES,
)


def _ranks(column: str, table: str) -> str:
    return f"""(SELECT {column} AS v, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS idx
        FROM {table} WHERE {column} IS NOT NULL GROUP BY 1)"""


def _words(table: str, key: str, column: str) -> str:
    return f"""words AS (SELECT {key}, term FROM (
        SELECT {key}, unnest(string_split_regex(lower({column}), '\\s')) AS term FROM {table}) WHERE term <> '')"""


def _tfidf(table: str, key: str, column: str) -> str:
    return f"""WITH {_words(table, key, column)},
        tf AS (SELECT {key}, term, count(*) AS tf FROM words GROUP BY 1, 2),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)
        SELECT {key}, term,
               round(tf * ln(((SELECT count(*) FROM {table}) + 1.0::DOUBLE) / (df + 1.0::DOUBLE)), 6) AS tfidf
        FROM tf JOIN df USING (term)"""


_DOCUMENT_WORDS = _words("documents", "doc_id", "text")
_SEGMENTS = "freq AS (SELECT segment, count(*) AS segment_count FROM cases GROUP BY 1)"

ORACLES = {
    "category_index": f"WITH {CASES} {_INDEX}",
    "category_index_wide": """SELECT 'c_name' AS "column", c_name AS value, count(*) AS cnt,
        row_number() OVER (ORDER BY count(*) DESC, c_name) - 1 AS idx FROM customer GROUP BY c_name""",
    "one_hot_long": f"""WITH {CASES}, idx AS ({_INDEX}),
        last AS (SELECT "column", max(idx) AS m FROM idx GROUP BY 1),
        cells AS ({per_column("SELECT case_id, '{c}' AS col, {c} AS v FROM cases", CATEGORIES)})
        SELECT case_id, idx."column", idx.idx AS slot FROM cells
        JOIN idx ON idx."column" = col AND idx.value = v JOIN last ON last."column" = col WHERE idx.idx < m""",
    "string_indexer_stage": f"WITH {CASES} SELECT case_id, "
    + ", ".join(
        f"coalesce({c}_rank.idx, (SELECT count(DISTINCT {c}) FROM cases)) AS si_{c}" for c in CATEGORIES
    )
    + " FROM cases "
    + " ".join(f"LEFT JOIN {_ranks(c, 'cases')} {c}_rank ON {c}_rank.v = cases.{c}" for c in CATEGORIES),
    "one_hot_stage": f"""WITH {CASES}, r AS (SELECT * FROM {_ranks('segment', 'cases')})
        SELECT case_id, idx::INT AS slot FROM cases JOIN r ON v = segment""",
    "wide_one_hot_stage": f"""WITH {CASES},
        s AS (SELECT subject AS v, row_number() OVER (ORDER BY count(*) DESC, subject) - 1 AS i
              FROM cases WHERE subject IS NOT NULL GROUP BY 1),
        k AS (SELECT case_id AS v, row_number() OVER (ORDER BY count(*) DESC, case_id::VARCHAR) - 1 AS i FROM cases GROUP BY 1),
        sizes AS (SELECT (SELECT count(*) FROM s) AS ns, (SELECT count(*) FROM k) AS nk)
        SELECT case_id, coalesce(s.i, ns) AS si_subject, k.i AS si_case,
            '(' || ns || ',[' || coalesce(s.i::VARCHAR, '') || '],[' || CASE WHEN s.i IS NULL THEN '' ELSE '1.0' END || '])' AS tf_subject,
            '(' || nk || ',[' || k.i || '],[1.0])' AS tf_case
        FROM cases CROSS JOIN sizes LEFT JOIN s ON s.v = subject JOIN k ON k.v = case_id""",
    "frequency_encode_left": f"""WITH {CASES}, {_SEGMENTS} SELECT case_id, cases.segment,
        coalesce(segment_count, 0) AS segment_count FROM cases LEFT JOIN freq ON freq.segment = cases.segment""",
    "frequency_encode_inner": f"""WITH {CASES}, {_SEGMENTS} SELECT case_id, cases.segment, segment_count
        FROM cases JOIN freq ON freq.segment = cases.segment""",
    "frequency_encode_stage": """SELECT o_orderkey,
        (count(*) OVER (PARTITION BY o_custkey))::DOUBLE AS fe_customer,
        (count(*) OVER (PARTITION BY o_orderpriority))::DOUBLE AS fe_priority FROM orders""",
    "hashed_terms_stage": r"""SELECT doc_id,
        len(string_split_regex(regexp_replace(text, '\s+$', ''), '\s'))::BIGINT AS n_words FROM documents""",
    "tokens": f"WITH {_DOCUMENT_WORDS} SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2",
    "document_frequency": f"WITH {_DOCUMENT_WORDS} SELECT term, count(DISTINCT doc_id) AS df FROM words GROUP BY 1",
    "idf_weights": f"""WITH {_DOCUMENT_WORDS} SELECT term, round(ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE)
        / (count(DISTINCT doc_id) + 1.0::DOUBLE)), 6) AS idf FROM words GROUP BY 1""",
    "tfidf": _tfidf("documents", "doc_id", "text"),
    "tfidf_subjects": _tfidf("part", "p_partkey", "p_name"),
    "hashed_terms_digest": f"""WITH {_DOCUMENT_WORDS} SELECT doc_id, {digest("term", TEXT_SLOTS)} AS slot,
        count(*) AS tf FROM words GROUP BY 1, 2""",
    "tokenizer_stage": f"""WITH {_DOCUMENT_WORDS} SELECT documents.doc_id, count(term) AS n_words
        FROM documents LEFT JOIN words USING (doc_id) GROUP BY 1""",
}
