"""Bloom filter of a few keys, tested while a large table is scanned.

The filter is built and read by built-in functions alone, so the test of a row is part of the scan's
generated code. Tasks turn keys into bit places; words of 64 bits are or-ed together, inside each
task first, and gathered as one array. A scalar subquery hands that array to the scan. What the
filter lets through may hold wrong keys, so a join has to confirm it; no right key is ever lost.

An array has at most ``MOST_WORDS`` words (16 MB), whatever the number of keys. Sources of more keys
than that holds at ``BITS_PER_KEY`` use it as full as they make it and let more rows through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 32
FEWEST_WORDS = 1 << 10
MOST_WORDS = 1 << 21
SALTS = (17, 71)


def places(keys: Sequence[str], words: int) -> list[Column]:
    """Bit places of a row's key, one for each salt; null where a key column is null."""
    known = F.lit(True)
    for key in keys:
        known &= F.col(key).isNotNull()
    return [F.when(known, F.pmod(F.xxhash64(F.lit(salt), *keys), F.lit(64 * words)))
            for salt in SALTS]


def words_for(n: int) -> int:
    """Words for ``n`` keys, a power of two."""
    words = FEWEST_WORDS
    while words < MOST_WORDS and 64 * words < BITS_PER_KEY * n:
        words *= 2
    return words


def bloom_words(source: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """One row with the filter of a frame's keys: ``words``, an array of 64-bit words."""
    place = source.select(F.explode(F.array(*places(keys, words))).alias("p")).where("p IS NOT NULL")
    filled = place.select(
        F.expr("CAST(p div 64 AS INT)").alias("word"),
        F.expr("shiftleft(1L, CAST(p % 64 AS INT))").alias("bit"))
    filled = filled.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = source.sparkSession.range(words).select(
        F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    every = every.unionByName(filled).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # One row of a bounded number of words.
    listed = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return every.agg(F.transform(listed, lambda w: w["bits"]).alias("words"))


def likely(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source may have; all that it does have are among them."""
    n = source.agg(F.approx_count_distinct(F.xxhash64(*keys)).alias("n")).first()["n"]
    words = words_for(n)
    held = bloom_words(source, keys, words)
    hit = F.lit(True)
    for place in places(keys, words):
        word = F.get(held.scalar(), F.shiftright(place, 6).cast("int"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                              F.pmod(place, F.lit(64)).cast("int"))
        hit &= word.bitwiseAND(bit) != 0
    return target.where(hit)
