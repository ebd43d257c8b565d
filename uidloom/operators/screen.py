"""A Bloom filter of lookup keys, to leave out candidates that cannot match before they are shuffled.

The filter is an array of words, made by Spark from the lookup and handed to the scan as a scalar subquery. It has a
fixed size whatever the lookup holds, so nothing has to be counted first. A key of the lookup always passes; any other
passes by chance, in one case of thirty at ``BITS`` / 8 keys, and in six of seven at ``BITS`` keys. So results never
depend on the filter, only the number of rows that are shuffled does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 1 << 23
"""Bits of a filter, a megabyte: it pays up to about two million keys. A power of two, at least 64."""
HASHES = 3
WORD_BITS = 64


def _places(value: Column, bits: int) -> list[Column]:
    """The bits of a value."""
    return [F.pmod(F.xxhash64(value, F.lit(seed)), F.lit(bits)) for seed in range(HASHES)]


def _word(place: Column) -> Column:
    return F.floor(place / WORD_BITS)


def key_filter(keys: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """One row with the filter of a column's values as the array ``words``; nulls are no keys.

    Bits of one word fall together before the shuffle. The array is put together in one task, of ``bits`` / 64 words.
    """
    place = keys.where(F.col(column).isNotNull()).select(F.explode(F.array(*_places(F.col(column), bits))).alias("place"))
    held = place.select(
        _word(F.col("place")).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("place", F.lit(WORD_BITS)).cast("int")).alias("bits"),
    )
    every = keys.sparkSession.range(bits // WORD_BITS).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = held.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return words.agg(F.transform(listed, lambda w: w["bits"]).alias("words"))


def may_hold(words: Column, value: Column, bits: int = BITS) -> Column:
    """Whether a value can be a key of the filter; null for a null value."""
    bit = [F.getbit(F.get(words, _word(p).cast("int")), F.pmod(p, F.lit(WORD_BITS)).cast("int")) == 1 for p in _places(value, bits)]
    passed = bit[0]
    for other in bit[1:]:
        passed = passed & other
    return F.when(value.isNotNull(), passed)
