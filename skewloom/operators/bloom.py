"""Joining a large table with few keys of another large table: rows without a partner go before the shuffle.

A Bloom filter of the wanted keys is a small table of 64-bit words. Each key falls on one word and sets a few of its bits, so
the scan of the other table looks at one word a row, by a broadcast join, inside generated code. The filter's size follows
the number of keys and has a bound; beyond the bound nothing is filtered, since a filter that is full lets all rows pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .joins import align

KEYS_PER_WORD = 4
BITS_PER_KEY = 5
MAX_WORDS = 1 << 20  # 16 MB of rows (word, bits)


def _mask(hashed: Column) -> Column:
    """The bits of a key within its word, from 6 bits of its hash each."""
    mask = F.lit(0).cast("long")
    for k in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(hashed, 34 + 6 * k).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def bloom_words(keys: DataFrame, columns: Sequence[str], words: int) -> DataFrame:
    """(_word, _bits): a filter of `words` words, a power of two, of the keys in `columns`."""
    hashed = keys.select(F.xxhash64(*columns).alias("_hash"))
    place = F.col("_hash").bitwiseAND(words - 1).alias("_word")
    return hashed.groupBy(place).agg(F.bit_or(_mask(F.col("_hash"))).alias("_bits"))


def bloom_filtered(df: DataFrame, columns: Sequence[str], keys: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """The rows of `df` whose `columns` may be a key of `keys` (the same columns): all that are, and few others.

    `keys` should be a stored table: its distinct keys are counted first, to size the filter. With more keys than the bound
    allows, `df` comes back as it is.
    """
    count = keys.select(F.approx_count_distinct(F.xxhash64(*columns))).first()[0]
    words = 1 << max(0, (count // KEYS_PER_WORD)).bit_length()
    if words > max_words:
        return df
    filled = store(bloom_words(keys, columns, words), "bloom-filter")
    hashed = F.xxhash64(*columns)
    marked = df.withColumn("_hash", hashed).join(F.broadcast(filled), F.col("_hash").bitwiseAND(words - 1) == F.col("_word"))
    mask = _mask(F.col("_hash"))
    return marked.filter(F.col("_bits").bitwiseAND(mask) == mask).drop("_hash", "_word", "_bits")


def selective_join(
    large: DataFrame, chosen: DataFrame, on: Mapping[str, str], prefix: str = "right_", max_words: int = MAX_WORDS
) -> DataFrame:
    """Inner join of `large` with the few rows `chosen`, a filtered frame that may itself be too large to broadcast.

    `chosen` is computed once and stored; a Bloom filter of its keys thins out `large` in its scan, before it is shuffled.
    """
    right = store(align(large, chosen, on, prefix), "chosen")
    keys = list(on)
    return bloom_filtered(large, keys, right.select(*keys), max_words).join(right, keys, "inner")
