"""A Bloom filter as a table of bitmaps, built and asked by expressions.

The filter's size follows from its capacity and rate of false hits alone, so it can be kept as
state, united with another of the same size, and broadcast while it is small.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a filter that is broadcast; a larger one is joined by shuffle.
MOST_BROADCAST = 64 << 20


class Size(NamedTuple):
    bits: int
    hashes: int


def size_for(capacity: int, false_hits: float) -> Size:
    """Bits and hash functions that keep false hits at that rate when so many keys are held."""
    bits = max(64, math.ceil(-capacity * math.log(false_hits) / math.log(2) ** 2))
    return Size(bits, max(1, round(bits / capacity * math.log(2))))


def _places(key: Column, size: Size) -> Column:
    """Distinct places of a key, from 1: two hashes, of which the second is added again and again."""
    bits = F.lit(size.bits)
    first, step = (F.pmod(F.xxhash64(key, F.lit(x)), bits) for x in "ab")
    return F.array_distinct(F.array(*(F.pmod(first + F.lit(k) * (step + 1), bits) + 1 for k in range(size.hashes))))


def build(keys: DataFrame, key: str, size: Size) -> DataFrame:
    """``bucket`` and ``bits`` of the filter that holds the keys; combined before the shuffle."""
    places = keys.where(F.col(key).isNotNull()).select(F.explode(_places(F.col(key), size)).alias("p"))
    return places.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))


def united(a: DataFrame, b: DataFrame) -> DataFrame:
    """The filter that holds the keys of both."""
    return a.union(b).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def without_held(rows: DataFrame, key: str, held: DataFrame, size: Size) -> DataFrame:
    """Rows whose key the filter surely doesn't hold; those with a null key stay.

    A row is asked for each of its places, and goes if all are set; the filter's rows are at most
    ``size.bits`` / 32,768 of 4 KB.
    """
    keys = rows.select(F.col(key).alias("_k")).where("_k is not null").distinct()
    asked = keys.select("_k", F.explode(_places(F.col("_k"), size)).alias("p")).select("_k", F.bitmap_bucket_number("p").alias("bucket"), F.bitmap_bit_position("p").alias("at"))
    bits = F.broadcast(held) if size.bits // 8 <= MOST_BROADCAST else held
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(F.col("at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    set_ = F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("at") % 8)), F.lit(2)) == 1, F.lit(False))
    hit = asked.join(bits, "bucket", "left").groupBy("_k").agg(F.every(set_).alias("_hit")).where("_hit").select("_k")
    return rows.join(hit, F.col(key) == F.col("_k"), "left_anti")
