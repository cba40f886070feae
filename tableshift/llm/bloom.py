"""A blocked Bloom filter out of DataFrame functions: 256-bit blocks of eight words, one bit set in each word per key.

The filter is a table of at most ``blocks`` rows of 36 bytes, whatever the number of keys, so broadcasting it is safe. More
keys than it was sized for mean more false passes, never a false miss; an exact join or group behind it removes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
MOST_BLOCKS = 1 << 18  # 9 MB: the size that may be broadcast


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """The bit of each word, from a second hash."""
    second = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(second, 5 * i).bitwiseAND(F.lit(31)).cast("int"))
            for i in range(WORDS)]


def blocked_bloom(keys: DataFrame, key: str, blocks: int = 1 << 16) -> DataFrame:
    """(bloom_block, bloom_0 .. bloom_7) over the non-null keys."""
    if not 0 < blocks <= MOST_BLOCKS:
        raise ValueError(f"a filter has 1 to {MOST_BLOCKS} blocks")
    words = [F.bit_or(b).alias(f"bloom_{i}") for i, b in enumerate(_bits(F.col(key)))]
    return (keys.filter(F.col(key).isNotNull()).groupBy(_block(F.col(key), blocks).alias("bloom_block")).agg(*words))


def may_contain(rows: DataFrame, key: str, bloom: DataFrame, blocks: int = 1 << 16, result: str = "bloom_hit") -> DataFrame:
    """Add a boolean: false means the key is certainly not in the filter. A null key is never in it."""
    marked = rows.withColumn("bloom_block", _block(F.col(key), blocks))
    hit = F.lit(True)
    for i, bit in enumerate(_bits(F.col(key))):
        hit = hit & (F.col(f"bloom_{i}").bitwiseAND(bit) != 0)
    joined = marked.join(F.broadcast(bloom), "bloom_block", "left")
    hit = F.coalesce(hit & F.col(key).isNotNull(), F.lit(False))
    return joined.withColumn(result, hit).drop("bloom_block", *[f"bloom_{i}" for i in range(WORDS)])
