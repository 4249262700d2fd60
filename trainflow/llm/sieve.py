"""A bounded sieve: tells rows that have no partner in a table, before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainflow.functions.names import free

#: Bits for each key, and most bits: at most 2**20 words of 64 bits are ever broadcast.
BITS_PER_KEY, MOST_BITS = 16, 1 << 26


def sieved(rows: DataFrame, column: str, keys: DataFrame, mark: str) -> DataFrame:
    """Adds ``mark``: false only if the hash ``column`` of a row surely is not among the keys.

    ``keys`` has the same column of hashes (longs). With more keys than the bits serve the sieve lets
    more rows pass, never fewer: what follows has to decide for those that are marked.
    """
    bits = 1 << 15
    wanted = BITS_PER_KEY * keys.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2

    word, bit, bits_of = free([*rows.columns, *keys.columns, mark], "__word", "__bit", "__bits")

    def place() -> Column:
        return F.pmod(F.col(column), F.lit(bits))

    at = F.expr(f"cast(pmod({column}, 64) as int)")
    words = (
        keys.withColumn(word, F.shiftright(place(), 6))
        .withColumn(bit, at)
        .groupBy(word)
        .agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias(bits_of))
    )
    held = rows.withColumn(word, F.shiftright(place(), 6)).withColumn(bit, at)
    held = held.join(F.broadcast(words), word, "left")
    there = F.coalesce(F.expr(f"(shiftright({bits_of}, {bit}) & 1) = 1"), F.lit(False))
    return held.withColumn(mark, there).drop(word, bit, bits_of)
