"""Log reduction before a join with few devices: a Bloom filter inside the plan.

A join of the log with its first-time users shuffles the whole log on the device once the
user side is too large to be broadcast. The users' ids are therefore first gathered
into a bitmap by an aggregate with a map-side part; its single row is a scalar subquery of
the same plan, so nothing is collected by the driver code and no job runs while the query is
built. Log rows whose device cannot be in the set drop in the scan's stage, before their
payload is read and before any shuffle. The join that follows removes what the
filter lets through too much, so results do not depend on the filter's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Devices for which a filter has its full effect unless told otherwise, and bits per device.
EXPECTED, BITS_PER_DEVICE = 500_000, 8
#: Bounds of the bitmap (as powers of two): 8 KB and 8 MB.
LEAST_LOG2, MOST_LOG2 = 16, 26


def log2_bits(expected: int) -> int:
    """Size of the bitmap for that many devices. Beyond the largest one the filter passes more
    rows but stays right."""
    return min(MOST_LOG2, max(LEAST_LOG2, (expected * BITS_PER_DEVICE - 1).bit_length()))


def _word_and_bits(key: Column, bits: int) -> tuple[Column, Column]:
    """A key's word of the bitmap and its three bits in it (a blocked Bloom filter: one look-up)."""
    h = F.xxhash64(key)
    one = F.lit(1).cast("bigint")
    held = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int"))
            for at in (40, 46, 52)]
    return h.bitwiseAND(F.lit((1 << (bits - 6)) - 1)), held[0].bitwiseOR(held[1]).bitwiseOR(held[2])


def bitmap(keys: DataFrame, key: str = "device_id", expected: int = EXPECTED) -> DataFrame:
    """One row ``words ARRAY<BIGINT>``: the bits of all non-null keys, 64 to a word."""
    bits = log2_bits(expected)
    word, held = _word_and_bits(F.col(key), bits)
    rows = keys.where(F.col(key).isNotNull()).select(word.alias("word"), held.alias("bits"))
    empty = keys.sparkSession.range(0, 1 << (bits - 6), 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = rows.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return words.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w")).select(F.col("w.bits").alias("words"))


def only_devices_of(log: DataFrame, devices: DataFrame, key: str = "device_id", expected: int = EXPECTED) -> DataFrame:
    """``log`` without rows whose ``key`` is null or, by the Bloom filter, not in ``devices``. Some
    rows of other devices may stay: a join with ``devices`` has to follow."""
    word, held = _word_and_bits(F.col(key), log2_bits(expected))
    words = bitmap(devices, key, expected).scalar()
    return log.where(F.col(key).isNotNull() & (F.element_at(words, (word + 1).cast("int")).bitwiseAND(held) == held))
