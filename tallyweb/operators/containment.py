"""What is inside what on a page, by numbers in document order: the elements inside one are those from node_id + 1 up to,
and without, subtree_end.

Containment is an equi-join. Numbers are dealt to aligned blocks of 1, 8, 64, ... elements; an element is in one block of
each size, and the elements inside one make up a few whole blocks of each size, each of them in one such block only. So the
rows that meet grow with elements times the logarithm of their page's length, not with their depth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let

#: Blocks of a size are 2 ** BITS of the next smaller size; numbers have up to 31 bits
BITS = 3
SIZES = -(-31 // BITS)
_NO_BLOCKS = "cast(array() as array<bigint>)"


def _block(size: Column, index: Column) -> Column:
    return size.cast("bigint") * (1 << 32) + index


def blocks_of(number: Column) -> Column:
    """The blocks that a number is in. Blocks before the first of a size are in no element (the root's number is 0), so sizes
    beyond the number itself are left out."""
    at = number.cast("bigint")
    sizes = F.filter(F.sequence(F.lit(0), F.lit(SIZES - 1)), lambda s: F.call_function("shiftright", at, s * BITS) > 0)
    return F.transform(sizes, lambda s: _block(s, F.call_function("shiftright", at, s * BITS)))


def blocks_inside(node_id: Column, subtree_end: Column) -> Column:
    """The blocks that make up the elements inside one: of each size those that lie inside but in no larger one that does."""
    begin, end = node_id.cast("bigint") + 1, subtree_end.cast("bigint")

    def first(size: Column) -> Column:  # the first block that begins inside
        return -F.call_function("shiftright", -begin, size * BITS)

    def beyond(size: Column) -> Column:  # the first one that doesn't end inside
        return F.call_function("shiftright", end, size * BITS)

    def between(size: Column, low: Column, high: Column) -> Column:
        return F.when(low < high, F.transform(F.sequence(low, high - 1), lambda i: _block(size, i))).otherwise(F.expr(_NO_BLOCKS))

    def of_size(size: Column) -> Column:
        low, high, wide = first(size), beyond(size), 1 << BITS
        larger = let(F.struct((first(size + 1) * wide).alias("low"), (beyond(size + 1) * wide).alias("high")), lambda x: edges(size, low, high, x))
        return F.when(low < high, larger).otherwise(F.expr(_NO_BLOCKS))

    def edges(size: Column, low: Column, high: Column, larger: Column) -> Column:
        both = F.concat(between(size, low, larger["low"]), between(size, larger["high"], high))
        return F.when(larger["low"] < larger["high"], both).otherwise(between(size, low, high))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(SIZES - 1)), of_size))


def inside(elements: DataFrame, holders: DataFrame, at: str = "at") -> DataFrame:
    """Each of `elements` (page_id, the number `at`, others) with each of `holders` (page_id, node_id, subtree_end, others)
    that it is inside of; no other column may be in both."""
    dealt = elements.select("*", F.explode(blocks_of(F.col(at))).alias("__block"))
    spans = holders.select("*", F.explode(blocks_inside(F.col("node_id"), F.col("subtree_end"))).alias("__block"))
    return dealt.join(spans, ["page_id", "__block"]).drop("__block")


def folded_inside(elements: DataFrame, holders: DataFrame, keys: list[str], folds: dict[str, tuple[Callable, Column]]) -> DataFrame:
    """(page_id, node_id, keys, folds): for each of `holders` and value of `keys`, F.min or F.max of columns of the `elements`
    (page_id, at, keys, others) inside. Blocks are folded before they meet the holders, so holders that are nested don't
    multiply what they hold. Spans are never broadcast: Spark takes what is exploded for as large as the compressed file."""
    dealt = elements.withColumn("__block", F.explode(blocks_of(F.col("at"))))
    blocks = dealt.groupBy("page_id", "__block", *keys).agg(*[fold(c).alias(name) for name, (fold, c) in folds.items()])
    spans = holders.select("page_id", "node_id", F.explode(blocks_inside(F.col("node_id"), F.col("subtree_end"))).alias("__block"))
    met = blocks.join(spans.hint("merge"), ["page_id", "__block"])
    return met.groupBy("page_id", "node_id", *keys).agg(*[fold(name).alias(name) for name, (fold, _) in folds.items()])


def following(value: Column) -> Column:
    """The nearest `value` that isn't null among the elements behind one in document order, of a page's elements. If it is
    of one before subtree_end, it is the first inside."""
    behind = Window.partitionBy("page_id").orderBy(F.desc("node_id")).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(value, ignorenulls=True).over(behind)
