"""A Bloom filter of keys, made and asked with built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.session import materialize

#: Bits a key, and hashes a key: about one in eighty foreign keys passes.
BITS_PER_KEY = 10
HASHES = 4
#: Filters above this size are not made, as each executor holds one.
MAX_BYTES = 32 * 1024 * 1024


def _places(keys: Sequence[str | Column], bits: int) -> list[Column]:
    """Where a key's bits are: a hash for each."""
    return [F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(bits).cast("bigint")) for seed in range(HASHES)]


def bloom_words(df: DataFrame, keys: Sequence[str], rows: int, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, int] | None:
    """One row with the filter's 64-bit words, and its bits; None if ``rows`` keys take more than ``max_bytes``.

    Bits meet by ``bit_or``, which tasks apply before the shuffle, so frequent keys and words cost no more
    than rare ones; only words, of which the size is bounded, meet in one task.
    """
    bits = 64 * max(1, -(-rows * BITS_PER_KEY // 64))
    if bits // 8 > max_bytes:
        return None
    place = df.dropna(subset=list(keys)).select(F.explode(F.array(*_places(keys, bits))).alias("_place"))
    parts = place.select(F.floor(F.col("_place") / 64).alias("_word"), F.expr("shiftleft(1L, cast(_place % 64 as int))").alias("_bit"))
    empty = df.sparkSession.range(bits // 64).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bit"))
    held = parts.unionByName(empty).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    listed = held.agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_held"))
    # Stored, so that a plan that asks the filter several times finds it made.
    return materialize(listed.select(F.col("_held._bits").alias("words")), "bloom"), bits


def might_be_in(keys: Sequence[str | Column], words: DataFrame, bits: int) -> Column:
    """Whether a key may be one of the filter's: true for all that are, and for few others."""
    held = words.scalar()

    def is_set(place: Column) -> Column:
        word = F.element_at(held, (F.floor(place / 64) + 1).cast("int"))
        return F.getbit(word, (place % 64).cast("int")) == 1

    return reduce(lambda a, b: a & b, [is_set(p) for p in _places(keys, bits)])
