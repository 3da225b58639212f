"""Benchmark decontamination by winnowing.

Of each window of consecutive k-gram hashes the smallest (the last of several) is kept as a fingerprint. Two texts that
share a run of `span` words share a window, and so a fingerprint: joining fingerprints misses no such run. Hits are
extended window by window: those that hold the fingerprint are compared whole, and those that agree make up the runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import free_prefix
from .staging import staged
from .words import Words, gram_hashes, hashed_words

SPAN = 10  # words of a window
GRAM = 5  # words of a k-gram; SPAN - GRAM + 1 of them are in a window
BROADCAST_BYTES = 32 << 20  # an index of items up to this size is sent to the tasks; larger ones are joined by shuffles
WORD_BYTES = 32  # of the index, for each word of an item, at most: a window, a fingerprint, and who has the window
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
RESULT = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", SPANS)]
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def windows(words: np.ndarray, bounds: np.ndarray, span: int = SPAN, k: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, fingerprints, hashes) of all windows of `span` words. bounds: where texts begin, and the last one ends."""
    grams = gram_hashes(words, k)
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    least = grams[:n].copy()
    for j in range(1, span - k + 1):
        np.minimum(least, grams[j : j + n], out=least)
    starts = np.flatnonzero(_whole(n, span, bounds))
    return starts, least[starts], gram_hashes(words, span)[starts]


def _whole(n: int, size: int, bounds: np.ndarray) -> np.ndarray:
    """Which of the first n runs of `size` words lie within one text."""
    ends = np.repeat(bounds[1:], np.diff(bounds))[:n]
    return np.arange(n) + size <= ends


def _short(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of all runs of n words, to be told from those of other lengths."""
    grams = gram_hashes(words, n)
    starts = np.flatnonzero(_whole(len(grams), n, bounds))
    return starts, grams[starts] ^ np.uint64(n)


def _found(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the values are among the sorted keys, and at what place these are)"""
    if not len(keys):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    place = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    at = np.flatnonzero(keys[place] == values)
    return at, place[at]


class Items:
    """Fingerprints and windows of items, as sorted arrays; items of fewer than `span` words are their only window."""

    def __init__(self, ids: list[str], texts: list[str], span: int = SPAN, k: int = GRAM):
        self.ids, self.span, self.k = ids, span, k
        prints, keys, owners, self.lengths = [], [], [], set()
        for w in hashed_words(pa.array(texts, pa.string())):
            item_of = np.repeat(np.arange(len(w)), np.diff(w.bounds)) + w.first
            starts, least, hashes = windows(w.hashes, w.bounds, span, k)
            prints.append(np.unique(least)), keys.append(hashes), owners.append(item_of[starts])
            sizes = np.diff(w.bounds)
            for n in set(sizes[(sizes > 0) & (sizes < span)].tolist()):
                self.lengths.add(n)
                starts, hashes = _short(w.hashes, w.bounds, n)
                own = sizes[item_of[starts] - w.first] == n
                keys.append(hashes[own]), owners.append(item_of[starts][own])
        empty = np.zeros(0, dtype=np.uint64)
        self.prints = np.unique(np.concatenate([empty, *prints]))
        pairs = np.unique(np.stack([np.concatenate([empty, *keys]), np.concatenate([empty, *owners]).astype(np.uint64)], axis=1), axis=0)
        self.keys, first = np.unique(pairs[:, 0], return_index=True)
        self.offsets, self.owners = np.append(first, len(pairs)), pairs[:, 1].astype(np.int64)

    def hits(self, w: Words) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(starts, places in keys, words) of all windows of the slice that are an item's."""
        starts, least, hashes = windows(w.hashes, w.bounds, self.span, self.k)
        near, _ = _found(least, self.prints)  # only hits of fingerprints are extended
        at, place = _found(hashes[near], self.keys)
        yield starts[near[at]], place, self.span
        for n in sorted(self.lengths):
            starts, hashes = _short(w.hashes, w.bounds, n)
            at, place = _found(hashes, self.keys)
            yield starts[at], place, n

    def results(self, w: Words) -> list[tuple]:
        """For each text of the slice what RESULT says."""
        delta = np.zeros(len(w.hashes) + 1, dtype=np.int64)
        text_of = np.repeat(np.arange(len(w)), np.diff(w.bounds))
        texts, places = [], []
        for starts, place, n in self.hits(w):
            np.add.at(delta, starts, 1)
            np.add.at(delta, starts + n, -1)
            texts.append(text_of[starts]), places.append(place)
        pairs = np.unique(np.stack([np.concatenate(texts), np.concatenate(places)], axis=1), axis=0)
        n_owners = self.offsets[pairs[:, 1] + 1] - self.offsets[pairs[:, 1]]
        owner = self.owners[np.repeat(self.offsets[pairs[:, 1]], n_owners) + np.arange(n_owners.sum()) - np.repeat(np.cumsum(n_owners) - n_owners, n_owners)]
        items: dict[int, set[str]] = {}
        for text, item in np.unique(np.stack([np.repeat(pairs[:, 0], n_owners), owner], axis=1), axis=0).tolist():
            items.setdefault(text, set()).add(self.ids[item])
        hit = np.cumsum(delta[:-1]) > 0
        out = []
        for i in range(len(w)):
            mine = hit[w.bounds[i] : w.bounds[i + 1]]
            out.append((len(mine), int(mine.sum()), sorted(items.get(i, ())), _runs(mine)))
        return out


def _runs(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))).tolist()
    return [{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2], strict=True)]


def find_contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`docs` with n_words, n_hit, items and spans added: the words hit by items, the items, and the hit runs of words.

    A word is hit if it lies in an occurrence of a window: `span` consecutive words of an item, or all words of an item of
    fewer. Words are those of words.py, known by 64-bit hashes. `items` are distinct item_ids as sorted strings, `spans`
    are merged (start, end). The work for a text is linear in its words, however often they repeat.

    Null and empty texts have no words. Items without words or with a null item_id are left out; repeated item_ids count
    once. Rows that repeat a doc_id are judged each by itself. Columns of `docs` named as results are replaced, others pass
    through, whatever their names; no items leave all documents clean, no documents give no rows.
    """
    docs = docs.drop(*[f.name for f in RESULT])
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.regexp_count("text", F.lit(WORD)) * WORD_BYTES + F.length("item_id") + 60)).first()[0] or 0
    if size > broadcast_bytes:
        return _joined(docs, items, span, k)
    rows = items.collect()  # of a size just checked
    sent = docs.sparkSession.sparkContext.broadcast(Items([r["item_id"] for r in rows], [r["text"] for r in rows], span, k))
    at, schema = docs.columns.index("text"), T.StructType([*docs.schema.fields, *RESULT])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _added(batch, [r for w in hashed_words(batch.column(at)) for r in sent.value.results(w)], schema)

    return docs.mapInArrow(judge, schema)


def _joined(docs: DataFrame, items: DataFrame, span: int, k: int) -> DataFrame:
    """As find_contamination(), for items of any size: distinct fingerprints of texts meet those of items by a join, then
    windows are made of the texts that met, where their fingerprint did, and meet those of items.

    Windows of n words, `span` or those of shorter items, have the least of their (n + 1) // 2-gram hashes for a fingerprint
    (k-gram where n is `span`), so about 2 in n - k + 2 words give one. Joins are on hashes, whose rows on the documents'
    side Spark may split where one is frequent; what is gathered for one text are its own fingerprints that met, and the
    places and items of its hits.
    """

    def made(w: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, fingerprints, hashes) of all windows of n words, to be told from those of other lengths."""
        starts, least, hashes = windows(w.hashes, w.bounds, n, k if n == span else (n + 1) // 2)
        return starts, least ^ np.uint64(n), hashes ^ np.uint64(n)

    def item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in hashed_words(batch.column(1)):
                text_of, sizes = np.repeat(np.arange(len(w)), np.diff(w.bounds)), np.diff(w.bounds)
                for n in np.unique(np.minimum(sizes[sizes > 0], span)).tolist():
                    starts, least, hashes = made(w, n)
                    own = np.minimum(sizes[text_of[starts]], span) == n
                    texts = batch.column(0).take(pa.array(text_of[starts][own] + w.first))
                    columns = [texts, *[pa.array(x[own].view(np.int64)) for x in (least, hashes)], pa.array(np.full(int(own.sum()), n))]
                    yield pa.RecordBatch.from_arrays(columns, names=["item_id", "print", "hash", "n"])

    of_items = staged(items.mapInArrow(item_windows, "item_id string, print long, hash long, n long").distinct(), "item_windows")
    lengths = sorted(r["n"] for r in of_items.select("n").distinct().collect())  # at most `span` numbers

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in hashed_words(batch.column(1)):
                text_of = np.repeat(np.arange(len(w)), np.diff(w.bounds))
                for n in lengths:
                    starts, least, _ = made(w, n)
                    pairs = np.unique(np.stack([text_of[starts].astype(np.uint64), least], axis=1), axis=0)
                    texts = batch.column(0).take(pa.array(pairs[:, 0].astype(np.int64) + w.first))
                    yield pa.RecordBatch.from_arrays([texts, pa.array(pairs[:, 1].copy().view(np.int64))], names=["key", "print"])

    def met_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = batch.column(2)
            values, ends = met.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.cumsum(np.append(0, met.value_lengths().to_numpy(zero_copy_only=False)))
            for w in hashed_words(batch.column(1)):
                text_of = np.repeat(np.arange(len(w)), np.diff(w.bounds))
                for n in lengths:
                    starts, least, hashes = made(w, n)
                    edges = np.searchsorted(text_of[starts], np.arange(len(w) + 1))
                    near = [np.flatnonzero(np.isin(least[edges[i] : edges[i + 1]], values[ends[w.first + i] : ends[w.first + i + 1]])) + edges[i] for i in range(len(w))]
                    near = np.concatenate([np.zeros(0, dtype=np.int64), *near])
                    own = text_of[starts[near]]
                    columns = [batch.column(0).take(pa.array(own + w.first)), pa.array(hashes[near].view(np.int64)), pa.array(starts[near] - w.bounds[own]), pa.array(np.full(len(near), n))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "hash", "start", "n"])

    p = free_prefix(docs)
    keyed = docs.withColumns({p + "a": F.xxhash64("text"), p + "b": F.hash("text")})
    of_docs = keyed.select(F.struct(F.col(p + "a").alias("a"), F.col(p + "b").alias("b")).alias("key"), "text")
    of_prints = of_docs.mapInArrow(prints, "key struct<a:long,b:int>, print long")
    met = of_prints.join(of_items.select("print").distinct(), "print", "left_semi").groupBy("key").agg(F.collect_set("print").alias("met"))
    near = of_docs.join(staged(met, "met_prints"), "key").mapInArrow(met_windows, "key struct<a:long,b:int>, hash long, start long, n long")
    hits = staged(near.join(of_items.select("hash", "item_id").distinct(), "hash").select("key", "start", "n", "item_id"), "window_hits")
    found = hits.groupBy("key").agg(F.collect_set("item_id").alias(p + "items"), F.collect_set(F.struct("start", "n")).alias(p + "marks"))
    found = found.select(F.col("key.a").alias(p + "fa"), F.col("key.b").alias(p + "fb"), F.sort_array(p + "items").alias(p + "items"), p + "marks")
    joined = keyed.join(found, (F.col(p + "a") == F.col(p + "fa")) & (F.col(p + "b") == F.col(p + "fb")), "left").select(*docs.columns, p + "items", p + "marks")
    at, schema = docs.columns.index("text"), T.StructType([*docs.schema.fields, *RESULT])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.concatenate([np.zeros(0, dtype=np.int64), *[np.diff(w.bounds) for w in hashed_words(batch.column(at))]])
            found = []
            for n, ids, marks in zip(sizes.tolist(), batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                delta = np.zeros(n + 1, dtype=np.int64)
                for m in marks or ():
                    delta[m["start"]] += 1
                    delta[m["start"] + m["n"]] -= 1
                hit = np.cumsum(delta[:-1]) > 0
                found.append((n, int(hit.sum()), ids or [], _runs(hit)))
            yield _added(batch.select(range(batch.num_columns - 2)), found, schema)

    return joined.mapInArrow(judge, schema)


def _added(batch: pa.RecordBatch, rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    more = [pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)


def contamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Counts and digests of find_contamination(), which says how odd rows are taken; one row for each row of `docs`."""
    found = find_contamination(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no window of an item, with their columns, those named as results of find_contamination() too.

    Null and empty texts stay; no items leave all rows, no rows give none; repeated rows stay or go together."""
    p = free_prefix(docs)
    kept = {c: p + c for c in docs.columns if c in [f.name for f in RESULT]}
    return find_contamination(docs.withColumnsRenamed(kept), items).where("n_hit = 0").select(*[F.col(kept.get(c, c)).alias(c) for c in docs.columns])
