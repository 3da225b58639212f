"""N-gram Jaccard join: near-duplicate classes of documents by a chosen-path join.

Documents are sets of word n-grams. Sets are split recursively on tokens that they choose by hashes which depend on the
path so far: similar sets are likely to choose a token in common. Small buckets are compared by brute force, large ones
are split further, and runs are repeated until the target recall is reached even at the greatest depth. What is found is
a graph of candidates; within its components every pair of sets is then verified exactly, in blocks.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import free_prefix
from .components import components
from .sieve import sieved
from .staging import staged
from .words import gram_hashes, hashed_words, mix

N_WORDS = 5
THRESHOLD = 0.8
BINS = 128  # tokens of an embedded set: the least n-gram of each of as many parts of the hash range
CLOSE = 0.9  # estimated similarity to a bucket's pivot from which on the pivot stands for a set
BUCKET = 2048  # sets that are compared by brute force: some tenths of a second, less than it costs to split them further
ROWS = 256  # of a bucket's matrix at a time
DEPTH = 4  # splits at most; what is large then is compared in blocks
SALTS = 32  # ways that sets with one pivot are dealt
BLOCK_SETS, BLOCK_GRAMS = 1024, 400_000  # of a block of exact comparison, about
TARGET_RECALL = 0.999  # of linked pairs, at the greatest depth; pairs that split less deep are found more often


@dataclass(frozen=True)
class Plan:
    """How a join at `threshold` splits: a set of m tokens chooses each with probability 1 / (split * m); pairs estimated at
    `candidate` or more are candidates (some 5 standard errors of the estimate below the threshold).

    Runs: two sets that share a share J of their tokens share J / split chosen tokens a level on average, so a run finds
    them after d levels with f(d) = 1 - exp(-f(d-1) * J / split). For a set that its pivot stands for, the pivot meets the
    set's neighbours, whose similarity to it is 1 - (1 - threshold) - (1 - CLOSE) at least (Jaccard distances add up at
    most); runs are as many as find pairs of that similarity with TARGET_RECALL at DEPTH, over the embedding's spread.
    """

    threshold: float = THRESHOLD

    @property
    def split(self) -> float:
        return 0.875 * self.threshold

    @property
    def candidate(self) -> float:
        return max(0.05, self.threshold - 0.2)

    def miss(self, runs: int, similarity: float | None = None, depth: int = DEPTH) -> float:
        """Probability that no run finds a pair of the similarity (or the least one that counts, see above)."""
        j = max(0.05, self.threshold - (1 - CLOSE)) if similarity is None else similarity
        total = 0.0
        for shared in range(BINS + 1):
            weight, found = math.comb(BINS, shared) * j**shared * (1 - j) ** (BINS - shared), 1.0
            for _ in range(depth):
                found = 1 - math.exp(-found * shared / (BINS * self.split))
            total += weight * (1 - found) ** runs
        return total

    @cached_property
    def runs(self) -> int:
        return next(n for n in itertools.count(1) if self.miss(n) <= 1 - TARGET_RECALL)


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    return np.unique(gram_hashes(words, min(n, len(words)))) if len(words) else np.zeros(0, dtype=np.uint64)


def _key(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64))


def _embedded(grams: np.ndarray) -> bytes:
    """BINS 32-bit values; 0 marks an empty part."""
    out = np.zeros(BINS, dtype=np.uint32)
    part = (grams >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    out[part[first]] = ((grams[first] >> np.uint64(25)).astype(np.uint32)) | np.uint32(1)
    return out.tobytes()


def _sets(docs: DataFrame, n: int) -> DataFrame:
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL("key long, n long, tokens binary").fields])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in hashed_words(batch.column(1)):
                keys, sizes, tokens = [], [], []
                for i in range(len(words)):
                    grams = _grams(words.of(i), n)
                    keys.append(_key(grams) if len(grams) else None), sizes.append(len(grams)), tokens.append(_embedded(grams) if len(grams) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(words.first, len(words)), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.binary())], names=schema.names
                )

    return docs.select("doc_id", "text").mapInArrow(make, schema)


def _matrix(column: pa.Array, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), BINS)


def _with_low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`small` added: a byte of each token, 0 for an empty one only. A quarter of the size, and enough to estimate."""
    for batch in batches:
        tokens = _matrix(batch.column("tokens"), np.uint32)
        small = np.where(tokens == 0, 0, (tokens >> np.uint32(8)) % np.uint32(255) + np.uint32(1)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.tobytes() for x in small], pa.binary())], names=[*batch.schema.names, "small"])


def _chosen(tokens: np.ndarray, path: np.ndarray, split: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, paths) of the tokens that sets choose under their paths."""
    ids = tokens.astype(np.uint64) + (np.arange(BINS, dtype=np.uint64) << np.uint64(32))
    h = mix(ids * np.uint64(0x9E3779B97F4A7C15) + path[:, None])
    share = 1 / (split * np.maximum(1, (tokens != 0).sum(axis=1)))
    bar = np.minimum(share * 2.0**64, 2.0**64 - 2048).astype(np.uint64)
    row, col = np.nonzero((h < bar[:, None]) & (tokens != 0))
    return row, mix(h[row, col] ^ (ids[row, col] * np.uint64(0xD6E8FEB86659FD93)) ^ path[row])


def _first_paths(plan: Plan):
    runs, split = plan.runs, plan.split

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                tokens, ids = _matrix(part.column(1), np.uint32), part.column(0).to_numpy()
                for run in range(runs):
                    row, path = _chosen(tokens, np.full(len(ids), mix(np.array([run + 1], dtype=np.uint64))[0]), split)
                    yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(ids[row])], names=["path", "rid"])

    return of


def _similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of row a (or rows, pairwise) to rows b, from low bytes of tokens."""
    same = ((a == b) & (a != 0)).sum(axis=-1)
    return same / np.maximum(1, ((a != 0) | (b != 0)).sum(axis=-1))


def _next_paths(split: float):
    """Of sets in large buckets of one pivot: either the pivot, or the paths further down (path null: rid and pivot are an
    edge)."""

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, tokens = part.column(0).to_numpy(), _matrix(part.column(1), np.uint32)
                pivot_ids, pivots = part.column(2).to_numpy(), _matrix(part.column(3), np.uint32)
                paths = part.column(4).flatten().to_numpy().view(np.uint64)
                of = np.repeat(np.arange(len(ids)), pa.compute.list_value_length(part.column(4)).to_numpy())
                close = (_similar(tokens, pivots) >= CLOSE) & (ids != pivot_ids)
                open_ = ~close[of]
                row, down = _chosen(tokens[of[open_]], paths[open_], split)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None] * int(close.sum()) + down.view(np.int64).tolist(), pa.int64()),
                        pa.array(np.concatenate([ids[close], ids[of[open_]][row]])),
                        pa.array([*pivot_ids[close].tolist(), *[None] * len(row)], pa.int64()),
                    ],
                    names=["path", "rid", "pivot"],
                )

    return of_rows


def _roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id that each row reaches over a symmetric boolean matrix."""
    root, most = ids.copy(), np.iinfo(np.int64).max
    while True:
        least = np.concatenate([np.where(linked[i : i + ROWS], root[None, :], most).min(axis=1) for i in range(0, len(ids), ROWS)])
        new = np.minimum(root, least)
        if (new == root).all():
            return root
        root = new


def _alike(small: np.ndarray, candidate: float) -> np.ndarray:
    """Which pairs of rows are candidates."""
    full = (small != 0).astype(np.float32)
    size, out = full.sum(axis=1), np.zeros((len(small), len(small)), dtype=bool)
    for i in range(0, len(small), ROWS):
        either = size[i : i + ROWS, None] + size[None, :] - full[i : i + ROWS] @ full.T
        # parts that are empty in both are equal, too
        same = np.stack([np.count_nonzero(small == row, axis=1) for row in small[i : i + ROWS]]) - (BINS - either)
        out[i : i + ROWS] = same >= candidate * np.maximum(1, either)
    return out


def _bucket_edges(candidate: float):
    """Edges that connect what is connected by candidate pairs of a bucket; not all those pairs."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for ids, tokens in zip(batch.column(0), batch.column(1), strict=True):
                ids = ids.values.to_numpy()
                root = _roots(_alike(np.frombuffer(b"".join(tokens.as_py()), dtype=np.uint8).reshape(len(ids), BINS), candidate), ids)
                u += ids[root != ids].tolist()
                v += root[root != ids].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return of


def _brute_force(buckets: DataFrame, nodes: DataFrame, candidate: float) -> DataFrame:
    """Edges of buckets (path, rid). Those of more than BUCKET sets are dealt to pairs of blocks."""
    sizes = buckets.groupBy("path").agg(F.count("*").alias("n")).select("path", F.ceil(F.col("n") / BUCKET).cast("int").alias("blocks"))
    rows = buckets.join(sizes, "path").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    rows = rows.select("path", "rid", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    groups = rows.groupBy("path", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).agg(F.array_sort(F.collect_set("rid")).alias("rids"))
    groups = groups.where(F.size("rids") > 1).select("rids").distinct().select(F.xxhash64("rids").alias("g"), F.explode("rids").alias("rid"))
    with_tokens = groups.join(nodes.select("rid", "small"), "rid").groupBy("g").agg(F.collect_list(F.struct("rid", "small")).alias("m"))
    return with_tokens.select("m.rid", "m.small").mapInArrow(_bucket_edges(candidate), "u long, v long")


def _candidates(nodes: DataFrame, plan: Plan) -> DataFrame:
    """Edges (u, v) that connect candidate pairs."""
    paths = staged(nodes.select("rid", "tokens").mapInArrow(_first_paths(plan), "path long, rid long"), "paths_1")
    edges = []
    for depth in range(1, DEPTH + 1):
        counts = paths.groupBy("path").agg(F.count("*").alias("n"), F.min("rid").alias("pivot")).where("n > 1")
        counts = staged(counts, f"buckets_{depth}")
        shared = staged(paths.join(counts, "path"), f"shared_{depth}")
        large = f"n > {BUCKET}" if depth < DEPTH else "false"
        small = shared.where(f"NOT ({large})").select("path", "rid")
        # below the first level few sets are left, and only these are shuffled
        those = nodes.select("rid", "small") if depth == 1 else sieved(nodes.select("rid", "small"), "rid", small, "rid")
        edges.append(staged(_brute_force(small, those, plan.candidate), f"edges_{depth}"))
        if depth == DEPTH or counts.where(large).isEmpty():
            break
        # one row for all paths of a set with one pivot: there are many paths, and in a group of like sets few pivots
        split = shared.where(large)
        rows = split.groupBy("rid", "pivot").agg(F.collect_list("path").alias("paths")).join(sieved(nodes.select("rid", "tokens"), "rid", split, "rid"), "rid")
        pivots = sieved(nodes.select(F.col("rid").alias("pivot"), F.col("tokens").alias("pivot_tokens")), "pivot", counts.where(large), "pivot")
        pivots = counts.where(large).select("pivot").distinct().join(pivots, "pivot")
        # a pivot of very many sets is met in as many tasks
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
        pivots = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.join(pivots, ["pivot", "salt"]).select("rid", "tokens", "pivot", "pivot_tokens", "paths")
        down = staged(rows.mapInArrow(_next_paths(plan.split), "path long, rid long, pivot long"), f"paths_{depth + 1}")
        edges.append(down.where("path IS NULL").select(F.col("rid").alias("u"), F.col("pivot").alias("v")).distinct())
        paths = down.where("path IS NOT NULL").select("path", "rid").distinct()
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def _verified(groups: DataFrame, threshold: float) -> DataFrame:
    """(rid, links, root) of each set in each group: the copies of sets that it is linked to, and a set that it is
    connected to. A group is one block, or two of which only pairs across count."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for k in range(batch.num_rows):
                ids, blocks, copies, n, grams = (batch.column(c)[k].values for c in range(5))
                ids, blocks, copies, n = (x.to_numpy(zero_copy_only=False) for x in (ids, blocks, copies, n))
                linked = _linked(n, np.frombuffer(b"".join(grams.to_pylist()), dtype=np.uint64), threshold)
                if len(set(blocks.tolist())) > 1:
                    linked &= blocks[:, None] != blocks[None, :]
                for column, values in zip(out, (ids, linked @ copies, _roots(linked, ids)), strict=True):
                    column += values.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["rid", "links", "root"])

    return groups.select("m.rid", "m.block", "m.copies", "m.n", "m.grams").mapInArrow(verify, "rid long, links long, root long")


def _linked(n: np.ndarray, grams: np.ndarray, threshold: float, cells: int = 4_000_000) -> np.ndarray:
    """Which of the sets, of n consecutive grams each, are at least so similar; exact."""
    m = len(n)
    row = np.repeat(np.arange(m), n)
    _, column, times = np.unique(grams, return_inverse=True, return_counts=True)
    often = times > 1
    place = np.cumsum(often) - 1
    stay = often[column]
    row, column = row[stay], place[column[stay]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width, total = max(1, cells // m), int(often.sum())
    common = np.zeros((m, m), dtype=np.float64)
    for at in range(0, total, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        x = np.zeros((m, min(width, total - at)), dtype=np.float32)
        x[row[lo:hi], column[lo:hi] - at] = 1
        common += x @ x.T
    linked = common + 1e-9 >= threshold * (n[:, None] + n[None, :] - common)
    np.fill_diagonal(linked, False)
    return linked


def _exact(docs: DataFrame, nodes: DataFrame, of: DataFrame, n_words: int, threshold: float) -> DataFrame:
    """(rid, links, root) of the sets in components (rid, comp), verified in blocks."""
    members = staged(of.join(nodes.select("rid", "rep", "n", "copies"), "rid"), "members")
    sizes = members.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("g"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("g") / BLOCK_GRAMS)).cast("int").alias("blocks")
    members = members.join(sizes.select("comp", blocks), "comp").withColumnRenamed("rep", "__rep")
    # most texts are in no component, and stay where they are
    texts = sieved(docs.select("doc_id", "text"), "doc_id", members, "__rep")
    texts = texts.join(members, texts["doc_id"].eqNullSafe(members["__rep"]))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_numpy()
            keep, grams_of = [], []
            for words in hashed_words(batch.column(0)):
                for i in range(len(words)):
                    grams = _grams(words.of(i), n_words)
                    if len(grams) and _key(grams) == ids[words.first + i]:
                        keep.append(words.first + i), grams_of.append(grams.tobytes())
            part = batch.select(range(1, batch.num_columns)).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(grams_of, pa.binary())], names=[*part.schema.names, "grams"])

    rows = texts.select("text", "rid", "comp", "blocks", "copies", "n").mapInArrow(own, "rid long, comp long, blocks int, copies long, n long, grams binary")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = rows.groupBy("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).agg(
        F.array_distinct(F.collect_list(F.struct("rid", "block", "copies", "n", "grams"))).alias("m")
    )
    return _verified(groups, threshold)


def near_duplicates(docs: DataFrame, n_words: int = N_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links) for each row of `docs`.

    Two documents are linked if the Jaccard similarity of their sets of `n_words` consecutive words is at least
    `threshold` (fewer words than that: one gram of them all). Copies of one set are linked. A class is what links
    connect; class_id is its smallest doc_id, and n_links counts the document's links, to copies and to others.

    Documents without words (null or empty texts too) are classes of their own. Rows that repeat a doc_id count as
    documents each. A null doc_id is class_id only where a class has no other. Extra columns are left out; no rows give
    no rows. Sets are told apart by 64-bit hashes.
    """
    sets = staged(_sets(docs, n_words), "sets")
    nodes = (
        sets.where("n > 0")
        .groupBy(F.col("key").alias("rid"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "n", "tokens")).alias("m"), F.count("*").alias("copies"))
        .select("rid", F.col("m.doc_id").alias("rep"), "m.n", "copies", "m.tokens")
    )
    nodes = staged(nodes.mapInArrow(_with_low_bytes, T.StructType([*nodes.schema.fields, T.StructField("small", T.BinaryType())])), "nodes")
    found = components(_candidates(nodes, Plan(threshold)), "candidates")
    of = found.select(F.col("u").alias("rid"), F.col("v").alias("comp"))
    of = staged(of.unionByName(found.select(F.col("v").alias("rid"), F.col("v").alias("comp")).distinct()), "candidate_components")
    exact = staged(_exact(docs, nodes, of, n_words, threshold), "verified")
    classes = components(exact.select(F.col("rid").alias("u"), F.col("root").alias("v")), "classes").select(F.col("u").alias("rid"), F.col("v").alias("class"))
    links = exact.groupBy("rid").agg(F.sum("links").alias("links"))
    named = nodes.select("rid", "rep", "copies").join(classes, "rid", "left").join(links, "rid", "left")
    named = named.select("rid", "rep", F.coalesce("class", "rid").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = named.groupBy("class").agg(F.min("rep").alias("class_id"))
    answer = staged(named.join(least, "class").select(F.col("rid").alias("key"), "class_id", "n_links"), "near_duplicates")
    out = sets.select("doc_id", "key", "n").join(answer, "key", "left")
    return out.select("doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """Of each class the document of the smallest doc_id, with its columns, whatever their names.

    Rows that repeat a doc_id stay or go together. Documents without words all stay, as near_duplicates() has each in a class
    of its own. A null doc_id stays where its class has no other. No rows give no rows.
    """
    name = free_prefix(docs) + "gone"
    gone = near_duplicates(docs.select("doc_id", "text")).where(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone[name]), "left_anti")
