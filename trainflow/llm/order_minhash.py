"""Document fingerprints that feel the order of words: Order MinHash, in DataFrame functions alone.

The k-mers of a text are runs of ``K`` words; repeated ones are told apart by their occurrence number.
Numbered k-mers are thrown into ``SLOTS`` slots in rounds, each with a hash of its own that gives a
k-mer's slot and rank. A slot keeps the two k-mers that are first by round, then rank, puts them back into text order
and hashes that tuple. Long texts fill all slots in the first round. Shorter ones are thrown until there are
``THROWS`` throws; as an earlier round goes before, further rounds would change nothing in a slot that has its two, and
texts of different lengths agree. Moving, changing or reordering words changes the tuples that hold them, so the share
of equal slots follows the edit distance, not only the words in common, at any length. A text of one
k-mer has no order: each slot hashes that alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainflow.operators.ranking import numbered
from trainflow.workspace import written

#: Words of a k-mer, and slots as bits of the hash; a slot's tuple has two k-mers.
K, SLOT_BITS = 2, 6
SLOTS = 1 << SLOT_BITS
#: Least number of throws: a slot is left without two of them once in 12 000 slots.
THROWS = 768
#: A throw is one number: slot, round (10 bits), rank, and in the lowest bits the place in the text,
#: taken modulo their range.
PLACE_BITS, RANK_BITS = 24, 24
PLACES = (1 << PLACE_BITS) - 1
RANKS = ((1 << RANK_BITS) - 1) << PLACE_BITS
SLOT_MASK = -1 << (64 - SLOT_BITS)
FIRST_KEY = -(1 << 63)


def _marked(name: str) -> str:
    return f"__omh_{name}"


def _starts(array: str, bits: int) -> Column:
    """Where the number above the lowest ``bits`` changes in a sorted array."""

    def high(i: Column) -> Column:
        return F.shiftright(F.get(F.col(array), i), bits)

    places = F.sequence(F.lit(0), F.size(array) - 1)
    return F.filter(places, lambda i: ~high(i).eqNullSafe(high(i - 1)))


def signed(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``SLOTS`` small numbers, null where a slot has no k-mer, which is rare; equal texts have equal ones.

    A text of fewer than ``K`` words is one k-mer; null and empty texts are one empty k-mer.
    Each step is a column that the next one reads more than once, so that it is computed once.
    """
    w, s, r, o, e, b, m = (_marked(x) for x in "wsroebm")
    trimmed = F.expr(f"trim(BOTH ' \t\n\r\f\x0b' FROM coalesce(`{text}`, ''))")
    df = df.withColumn(w, F.split(trimmed, "[ \t\n\r\f\x0b]+"))

    def kmer(i: Column) -> Column:
        digest = F.xxhash64(*(F.get(F.col(w), i + j) for j in range(K)))
        return F.shiftleft(digest, PLACE_BITS).bitwiseOR(i.cast("long").bitwiseAND(PLACES))

    kmers = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0))), kmer)
    df = df.withColumn(s, F.sort_array(kmers)).withColumn(r, _starts(s, PLACE_BITS))

    def run(first: Column, j: Column) -> Column:
        return F.sequence(F.lit(0), F.coalesce(F.get(F.col(r), j + 1), F.size(s)) - first - 1)

    def throws(round_: Column) -> Column:
        def one(x: Column, occurrence: Column) -> Column:
            digest = F.xxhash64(F.shiftright(x, PLACE_BITS), occurrence, round_)
            rank = F.shiftright(digest, 64 - SLOT_BITS - RANK_BITS - PLACE_BITS).bitwiseAND(RANKS)
            number = F.shiftleft(round_.cast("long"), PLACE_BITS + RANK_BITS)
            mixed = digest.bitwiseAND(SLOT_MASK).bitwiseOR(number).bitwiseOR(rank)
            return F.coalesce(mixed.bitwiseOR(x.bitwiseAND(PLACES)), F.lit(0).cast("long"))

        return F.zip_with(F.col(s), F.col(o), one)

    df = df.withColumn(o, F.flatten(F.transform(F.col(r), run)))
    last = F.floor((F.lit(THROWS - 1)) / F.size(s)).cast("int")
    several = F.flatten(F.transform(F.sequence(F.lit(0), last), throws))
    df = df.withColumn(e, F.sort_array(F.when(last == 0, throws(F.lit(0))).otherwise(several)))
    slot_shift = 64 - SLOT_BITS
    df = df.withColumn(b, _starts(e, slot_shift))

    def place(x: Column) -> Column:
        return x.bitwiseAND(PLACES)

    def slot(first: Column, j: Column) -> Column:
        one, next_ = F.get(F.col(e), first), F.get(F.col(e), first + 1)
        end = F.coalesce(F.get(F.col(b), j + 1), F.size(e))
        # Only a later round can throw the same k-mer into the slot again.
        other = F.filter(F.slice(F.col(e), first + 1, end - first), lambda x: place(x) != place(one))
        two = F.when((first + 1 < end) & (place(next_) != place(one)), next_).otherwise(F.get(other, F.lit(0)))
        return F.struct(one.alias("one"), two.alias("two"))

    def entry(kept: Column) -> Column:
        one, two = kept["one"], kept["two"]
        high = lambda x: F.shiftright(x, PLACE_BITS)
        digest = (
            F.when(two.isNull(), F.xxhash64(high(one)))
            .when(place(two) < place(one), F.xxhash64(high(two), high(one)))
            .otherwise(F.xxhash64(high(one), high(two)))
        )
        number = (digest.bitwiseAND(0xFFFF) - 0x8000).cast("smallint")
        return F.struct(F.shiftright(one, slot_shift).cast("int"), number)

    df = df.withColumn(m, F.map_from_entries(F.transform(F.transform(F.col(b), slot), entry)))
    half = SLOTS // 2
    slots = F.transform(F.sequence(F.lit(-half), F.lit(half - 1)), lambda c: F.try_element_at(F.col(m), c))
    df = df.withColumn(name, F.when(F.size(m) > 0, slots))
    return df.drop(w, s, r, o, e, b, m)


def likeness(a: Column, b: Column) -> Column:
    """The share of slots, among those that either side fills, that are equal; 0 to 1."""
    equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda z: z)
    filled = F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x, y)), lambda z: z.isNotNull())
    return F.size(equal) / F.greatest(F.size(filled), F.lit(1))


def as_text(slots: Column) -> Column:
    """Four hexadecimal digits a slot, dashes where it is empty."""
    digits = F.transform(slots, lambda x: F.coalesce(F.lower(F.lpad(F.hex(x + F.lit(0x8000)), 4, "0")), F.lit("----")))
    return F.array_join(digits, "")


def _neighbours(ids: DataFrame) -> DataFrame:
    """For each key: the next smaller one, the next larger one and its need; the ends meet."""
    ranked = written(numbered(ids.withColumn("g", F.lit(0)), "g", [F.desc("d")], "rank"), "ranks")
    total = F.lit(max(1, ranked.count()))
    after = ranked.select(F.pmod(F.col("rank") - 1, total).alias("rank"), F.col("d").alias("next"))
    before = ranked.select(F.pmod(F.col("rank") + 1, total).alias("rank"), F.col("d").alias("previous"), F.col("need"))
    return ranked.select("d", "k", "rank").join(after, "rank").join(before, "rank").drop("rank")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its key (a long), ``n_chars``, ``edited``, the slots of the text
    and of the edited text, and how alike its slots are to those of the edited and the next text.

    The next document has the next smaller key, after the smallest comes the largest. The edited
    text has its last third (rounded down, in code points) replaced by as many first ones of the next
    document's text, or all of it. Null texts are empty. Of rows with the same key, which all have the
    same next document, the one whose text has the smallest digest stands for the key. A null key is
    the smallest. Other columns are not carried; an empty table gives no rows.
    """
    own = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(FIRST_KEY)).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    sizes = docs.select(F.col(key).cast("long").alias("k"), F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("n"))
    ids = sizes.groupBy(F.coalesce("k", F.lit(FIRST_KEY)).alias("d")).agg(
        F.first("k", ignorenulls=True).alias("k"), F.floor(F.max("n") / 3).cast("int").alias("need")
    )
    links = written(_neighbours(ids), "neighbours")
    joined = own.join(links, "d")
    digest = F.xxhash64("t")
    heads = joined.select(F.col("previous").alias("p"), F.expr("substring(t, 1, need)").alias("head"), digest.alias("h"))
    heads = heads.groupBy("p").agg(F.min(F.struct("h", "head"))["head"].alias("head"))
    both = joined.select("d", "k", "next", "t").join(heads, F.col("d") == F.col("p"))
    both = both.withColumn("n_chars", F.char_length("t").cast("long"))
    both = both.withColumn("cut", F.floor(F.col("n_chars") / 3).cast("int"))
    both = both.withColumn("edited", F.expr("concat(substring(t, 1, cast(n_chars as int) - cut), substring(head, 1, cut))"))
    both = signed(signed(both, "t", "slots"), "edited", "edited_slots")
    rows = both.select("d", "k", "next", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "slots", "edited_slots", digest.alias("h"))
    rows = written(rows, "signatures")
    standing = rows.groupBy("d").agg(F.min_by("slots", "h").alias("next_slots")).withColumnRenamed("d", "p")
    return rows.join(standing, F.col("next") == F.col("p")).select(
        F.col("k").alias(key),
        "n_chars",
        "edited_sha256",
        "slots",
        "edited_slots",
        likeness(F.col("slots"), F.col("edited_slots")).alias("near_edited"),
        likeness(F.col("slots"), F.col("next_slots")).alias("near_next"),
    )
