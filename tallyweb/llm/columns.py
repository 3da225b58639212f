"""Helpers for columns: free names, and scans over arrays in linear work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

CHUNK = 256  # results that grow one by one at a time; an array that grows is copied at each step


def free_prefix(*frames: DataFrame) -> str:
    """Underscores that no column of the frames begins with, so that whatever follows them is a free name."""
    prefix = "__"
    while any(c.startswith(prefix) for df in frames for c in df.columns):
        prefix += "_"
    return prefix


def scan(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], out: str) -> Column:
    """The results, as array<out>, of step(state, item) -> (next state, result) along an array.

    Results are gathered in chunks, so the work is about linear in the array's length.
    """
    none = F.expr(f"cast(array() as array<{out}>)")

    def through(part: Column, state: Column) -> Column:
        def one(acc: Column, x: Column) -> Column:
            state, result = step(acc["state"], x)
            return F.struct(state.alias("state"), F.concat(acc["out"], F.array(result)).alias("out"))

        return F.aggregate(part, F.struct(state.alias("state"), none.alias("out")), one)

    def all_of(array: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(array) - 1) / CHUNK).cast("int")), lambda c: F.slice(array, c * CHUNK + 1, CHUNK))
        begin = F.struct(start.alias("state"), F.expr(f"cast(array() as array<array<{out}>>)").alias("out"))
        grow = lambda acc, part: let(through(part, acc["state"]), lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")))
        return F.when(F.size(array) > 0, F.aggregate(chunks, begin, grow, lambda acc: F.flatten(acc["out"]))).otherwise(none)

    return let(items, all_of)


def starts_of(lengths: Column) -> Column:
    """Where each of consecutive pieces begins, of an int array of their lengths."""
    return scan(lengths, F.lit(0), lambda at, n: (at + n, at), "int")
