"""Rows that a join may need, told before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import free_prefix

SLOTS = 1 << 25  # hashed keys are told apart in so many bits: 1024 bitmaps of 4 KB


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)) + 1


def sieved(df: DataFrame, key: str, wanted: DataFrame, of: str) -> DataFrame:
    """The rows of `df` whose `key` is among the values of column `of` in `wanted` (null is a value), and few others.

    Both columns have one type. The values are known by bitmaps of a fixed size, at most 4 MB, which are broadcast. More
    than some ten millions of them let more of the others through; none is ever lost, so the join that follows decides.
    """
    name = free_prefix(df)
    slots = wanted.select(_slot(of).alias("slot"))
    slots = slots.select(F.bitmap_bucket_number("slot").alias(name + "bucket"), F.bitmap_bit_position("slot").alias("position"))
    bitmaps = slots.repartition(name + "bucket").groupBy(name + "bucket").agg(F.bitmap_construct_agg("position").alias(name + "bits"))
    position = F.bitmap_bit_position(_slot(key))
    byte = F.conv(F.hex(F.substring(name + "bits", F.floor(position / 8).cast("int") + 1, 1)), 16, 10).cast("long")
    there = F.getbit(byte, (position % 8).cast("int")) == 1
    return df.join(F.broadcast(bitmaps), (F.bitmap_bucket_number(_slot(key)) == F.col(name + "bucket")) & there, "left_semi")
