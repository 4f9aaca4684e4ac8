"""A Bloom filter of a key set (one hash) as a small table of bitmaps.

Keys are hashed to slots; Spark's bitmap functions keep the slots in use,
32,768 to a row. ``may_hold`` keeps the rows whose key's slot is in use: every
key of the set passes, and about one other key in ``BITS_PER_KEY``. The
filter takes ``BITS_PER_KEY / 8`` bytes a key, whatever the keys are, and is
broadcast: callers check ``filter_bytes`` against their budget first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
ROW_BITS = 32_768


def filter_slots(keys: int) -> int:
    return ROW_BITS * max(1, math.ceil(keys * BITS_PER_KEY / ROW_BITS))


def filter_bytes(keys: int) -> int:
    """Bytes of the filter of so many keys."""
    return filter_slots(keys) // 8


def _slot(key: str, keys: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(filter_slots(keys))) + F.lit(1)


def key_filter(df: DataFrame, key: str, keys: int) -> DataFrame:
    """The bitmaps of ``key``'s values in ``df``; ``keys`` is how many there are."""
    slots = df.select(_slot(key, keys).alias("_slot"))
    rows = slots.groupBy(F.bitmap_bucket_number("_slot").alias("_kf_bucket"))
    return rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_kf_bits"))


def may_hold(df: DataFrame, key: str, bitmaps: DataFrame, keys: int) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in the filter; map-only but for the broadcast."""
    place = F.bitmap_bit_position(F.col("_kf_slot"))
    byte = F.conv(F.hex(F.substring(F.col("_kf_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    found = df.withColumn("_kf_slot", _slot(key, keys)).withColumn("_kf_bucket", F.bitmap_bucket_number("_kf_slot"))
    found = found.join(F.broadcast(bitmaps), "_kf_bucket")
    return found.where(F.bit_get(byte.cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1).select(*df.columns)
