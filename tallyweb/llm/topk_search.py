"""Exact top-k search by inner product: columnar branch-and-bound.

Candidates lie in blocks, column by column, the columns by falling share of their mass. Scores are accumulated one block
of dimensions after another; after each, Cauchy-Schwarz on the remaining dimensions bounds what a candidate can still
reach, and those below the k-th best lower bound are compacted away. A first block of candidates gives each query a bound
that all further blocks begin with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

BLOCK_ROWS = 8192  # candidates in a block
BLOCK_QUERIES = 8192  # queries in a block
SLICE_QUERIES = 256  # of a block at a time
DIMS = 16  # dimensions in a step
EXACT = 2.0**53  # float64 sums of integers are exact below
HUGE = 2.0**200  # components from which on squares and bounds aren't trusted to floats at all
FOUND = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, and all components finite."""
    finite = lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    return F.coalesce(F.forall(vector, lambda v: finite(v.cast("double"))) & (F.size(vector) > 0), F.lit(False))


def _quantised(x: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(scale * x)


def _integers(x: np.ndarray, scale: int) -> list[int]:
    """floor(scale * x) exactly as floats have it, also where that is beyond the floats."""
    return [math.floor(scale * v) if abs(v) < EXACT else int(v) * scale for v in x.tolist()]


def _search(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int, scale: int) -> Iterator[tuple[int, int, int]]:
    """(query id, candidate id, score) of each query's k best of the rows, its own id left out, as far as they reach the
    query's floor (-inf if there is none)."""
    r, q = _quantised(rows, scale), _quantised(queries, scale)
    most_r, most_q, d = np.abs(r).max(initial=0), np.abs(q).max(initial=0), r.shape[1]
    if max(most_r, most_q) >= HUGE:
        for i, own in enumerate(query_ids):
            yield from _exact(own, ids, rows, queries[i], k, scale)
        return
    exact = most_r * most_q * d < EXACT
    order = np.argsort(-(r**2).sum(axis=0), kind="stable")
    columns, q = np.ascontiguousarray(r[:, order].T), q[:, order]  # one row a dimension
    edges = [*range(0, d, DIMS), d]
    tails = np.stack([np.sqrt((columns[e:] ** 2).sum(axis=0)) for e in edges[1:]])
    q_tails = np.stack([np.sqrt((q[:, e:] ** 2).sum(axis=1)) for e in edges[1:]])
    # what rounding can add up to, where sums aren't exact
    off = np.zeros((len(q), 1)) if exact else 2 * d * 2.0**-52 * np.sqrt((q**2).sum(axis=1))[:, None]
    norms = np.sqrt((columns**2).sum(axis=0))
    for at in range(0, len(q), SLICE_QUERIES):
        head = q[at : at + SLICE_QUERIES, : edges[1]] @ columns[: edges[1]]
        for i in range(at, at + len(head)):
            alive = np.flatnonzero(ids != query_ids[i])
            part = head[i - at, alive]
            for j in range(1, len(edges)):
                slack = q_tails[j - 1, i] * tails[j - 1, alive] * (1 + 1e-9) + off[i] * norms[alive]
                floor = floors[i]
                if len(alive) > k:
                    floor = max(floor, np.partition(part - slack, len(part) - k)[len(part) - k])
                stay = part + slack >= floor - 0.5  # scores are integers
                alive, part = alive[stay], part[stay]
                if j < len(edges) - 1:
                    part = part + q[i, edges[j] : edges[j + 1]] @ columns[edges[j] : edges[j + 1], alive]
            if exact:
                for b in np.lexsort((ids[alive], -part))[:k].tolist():
                    yield int(query_ids[i]), int(ids[alive[b]]), int(part[b])
            else:
                yield from _exact(query_ids[i], ids[alive], rows[alive], queries[i], k, scale)


def _exact(own: int, ids: np.ndarray, rows: np.ndarray, query: np.ndarray, k: int, scale: int) -> Iterator[tuple[int, int, int]]:
    """As _search(), for one query, in integers of any size; a score that is no long is an error."""
    q = _integers(query, scale)
    scores = [sum(a * b for a, b in zip(_integers(r, scale), q, strict=True)) for r in rows]
    best = sorted((i for i in range(len(ids)) if ids[i] != own), key=lambda i: (-scores[i], ids[i]))[:k]
    for i in best:
        if not -(2**63) <= scores[i] < 2**63:
            raise ValueError(f"the score of {own} and {ids[i]} is beyond 64 bits")
        yield int(own), int(ids[i]), scores[i]


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of each row for which `queries` holds, over all rows.

    Components are quantised to floor(scale * x); ties go to the smaller id. Rows with a null id, and vectors that are
    null or empty or hold a null or non-finite component, take no part; vectors of different lengths don't meet. A query
    never finds rows of its own id; repeated rows are else candidates of their own. Scores are exact for components of
    any size; one among the best that is beyond a long is an error. Extra columns are left out; no rows give no rows.

    Both sides are cut into blocks by hash, and each block of candidates meets each block of queries once.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    counts = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    blocks, query_blocks = -(-counts["n"] // BLOCK_ROWS) or 1, -(-counts["q"] // BLOCK_QUERIES) or 1
    number = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    rows = rows.withColumn("block", number(blocks, 1))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy(dtype=bool)
        found = []
        if asks.any() and not asks.all():
            ids, v, floors = pdf["id"].to_numpy(dtype=np.int64), np.stack(pdf["v"].to_numpy()), pdf["floor"].to_numpy(dtype=np.float64, na_value=-np.inf)
            found = list(_search(ids[~asks], v[~asks], ids[asks], v[asks], np.where(np.isnan(floors), -np.inf, floors)[asks], k, scale))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    def met(candidates: DataFrame, asking: DataFrame, of_blocks: list[int]) -> DataFrame:
        """asking has a `floor`."""
        sides = candidates.select(
            "dim", "block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"), F.lit(False).alias("asks"), "id", "v", F.lit(None).cast("double").alias("floor")
        ).unionByName(
            asking.select(
                "dim", F.explode(F.sequence(F.lit(of_blocks[0]), F.lit(of_blocks[-1]))).alias("block"), number(query_blocks, 2).alias("query_block"), F.lit(True).alias("asks"), "id", "v", "floor"
            )
        )
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = sides.repartition(max(parts, min(len(of_blocks) * query_blocks, 4 * parts)), "dim", "block", "query_block")
        return dealt.groupBy("dim", "block", "query_block").applyInPandas(search, FOUND)

    asking = rows.where("is_query")
    best = met(rows.where("block = 0"), asking.withColumn("floor", F.lit(None).cast("double")), [0])
    if blocks > 1:
        best = staged(best, "top_k_first_block")
        # the k-th best of a part of the candidates is a lower bound of the k-th best of all
        floors = _ranked(best).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
        best = best.unionByName(met(rows.where("block > 0"), asking.join(floors, "id", "left"), [*range(1, blocks)]))
    return _ranked(best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
