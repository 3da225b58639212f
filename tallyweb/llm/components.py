"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged

ROUNDS = 60


def _check(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
    return row["n"], row["h"] or 0


def components(edges: DataFrame, name: str) -> DataFrame:
    """(u, v): each node u of `edges` (u, v) that isn't the least of its component, with that least node v.

    Edges to a node itself are left out; repeated ones do no harm.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = staged(edges, name), None
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = staged(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), name)
        now = _check(edges)
        if now == before:
            return edges
        before = now
    raise ValueError(f"components of {name} haven't settled in {ROUNDS} rounds")
