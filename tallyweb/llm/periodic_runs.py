"""Periodic runs of words, by suffix classes united in descending order of their common prefixes.

A run is a stretch of words with smallest period q (words q apart are the same) and a length of at least max(min_length,
2 q) that no neighbouring word extends keeping period q.

Of a run from word s on, the suffixes at s and s + q share exactly the run's last (length - q) words, and
length - q >= `base`, half of min_length. So:

1. Suffixes of documents in which `base` words repeat are ranked by prefix doubling, many documents at a time in numpy;
   only suffixes whose first `base` words repeat in their document go on. Neighbours' common prefixes (LCP) follow from
   the ranks of all levels.
2. Edges between neighbours in the order of suffixes are taken by descending LCP, as Kruskal's algorithm does: union-find
   over classes that keep their positions in order, the smaller class put into the larger. Positions i < k that come to be
   next to each other in a class of LCP l, with k - i <= l, have period k - i up to word k + l; were it not the smallest
   period, the class had a position in between.
3. Those that the word before i doesn't extend are the runs, each found once, from its own beginning.

Word ids are exact (no hashes decide). Work is n log n but for the moves within ordered lists, memory the text times the
number of doublings. Documents are rows and are worked on alone; nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix

GATHER_BYTES = 2 << 20  # texts are worked on together up to about this size; a longer text is worked on alone
RUN = "struct<start:long,length:long,period:long>"
_ARROW_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_STEP = np.uint64(0xD6E8FEB86659FD93)


def repeating(ids: np.ndarray, doc: np.ndarray, base: int) -> np.ndarray:
    """Documents in which some `base` words may occur again (all that do, and hardly any others: hashes are compared)."""
    n = len(ids) - base + 1
    if n <= 0:
        return np.zeros(0, dtype=doc.dtype)
    h = mix(doc[:n].astype(np.uint64) + np.uint64(1))
    for k in range(base):
        h = h * _STEP + ids[k : k + n].astype(np.uint64) + np.uint64(1)
    inside = doc[:n] == doc[base - 1 :]
    own = doc[:n][inside]
    order = np.argsort(h[inside])
    h = h[inside][order]
    return np.unique(own[order][1:][h[1:] == h[:-1]])


def suffix_edges(ids: np.ndarray, doc: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, k, lcp) of neighbours in the order of suffixes that share `base` words at least and are of one document.

    ids are at least 1; documents stand one after the other.
    """
    n = len(ids)
    text = np.zeros(n + base * (int(doc[-1]) + 1), dtype=np.int64)  # documents are parted by `base` zeros
    own = np.arange(n) + base * doc
    text[own] = ids
    many = int(ids.max()) + 1
    code = doc.astype(np.int64)
    for k in range(base):
        code = np.unique(code * many + text[own + k], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    place = np.flatnonzero(np.append(True, code[order][1:] != code[order][:-1]))
    sizes = np.diff(np.append(place, n))
    rank = np.full(len(text), -1, dtype=np.int64)
    rank[own[order]] = np.repeat(place, sizes)  # of equal ones the place of the first
    active = own[order][np.repeat(sizes > 1, sizes)]
    levels, step = [rank.copy()], base
    open_ones = active
    while len(open_ones):
        first, second = rank[open_ones], rank[open_ones + step]
        by = np.lexsort((second, first))
        first, second, at = first[by], second[by], open_ones[by]
        new_first = np.append(True, first[1:] != first[:-1])
        new = new_first | np.append(True, second[1:] != second[:-1])
        index = np.arange(len(at))
        begins = np.maximum.accumulate(np.where(new_first, index, 0))
        groups = np.maximum.accumulate(np.where(new, index, 0))
        rank[at] = first + groups - begins
        more = ~(new & np.append(new[1:], True))
        open_ones = at[more]
        levels.append(rank.copy())
        step *= 2
    active = active[np.argsort(rank[active], kind="stable")]
    i, k = active[:-1], active[1:]
    same = levels[0][i] == levels[0][k]
    i, k = i[same], k[same]
    lcp = np.zeros(len(i), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = levels[level][i + lcp], levels[level][k + lcp]
        lcp += np.where((a == b) & (a >= 0), base << level, 0)
    for _ in range(base - 1):
        a, b = text[i + lcp], text[k + lcp]
        grows = (a == b) & (a > 0)
        if not grows.any():
            break
        lcp += grows
    back = np.full(len(text), -1, dtype=np.int64)
    back[own] = np.arange(n)
    return back[i], back[k], lcp


def seeds(i: np.ndarray, k: np.ndarray, lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """(i, k, lcp): positions next to each other in a class of suffixes with that LCP, not further apart than it."""
    order = np.argsort(-lcp, kind="stable")
    root: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    after: dict[int, int] = {}  # of each position the next one in its class
    told: dict[int, int] = {}  # as it was at the end of the levels before
    out: list[tuple[int, int, int]] = []
    fresh: list[int] = []  # positions whose next one changed on this level

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    def settle(level: int) -> None:
        for x in set(fresh):
            y = after.get(x)
            if y is not None and told.get(x) != y:
                told[x] = y
                if y - x <= level:
                    out.append((x, y, level))
        fresh.clear()

    level = -1
    for a, b, its in zip(i[order].tolist(), k[order].tolist(), lcp[order].tolist(), strict=True):
        if its != level:
            settle(level)
            level = its
        a, b = find(a), find(b)
        if a == b:
            continue
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        root[b] = a
        for x in small:
            at = bisect(large, x)
            large.insert(at, x)
            if at:
                after[large[at - 1]] = x
                fresh.append(large[at - 1])
            if at + 1 < len(large):
                after[x] = large[at + 1]
                fresh.append(x)
            else:
                after.pop(x, None)
        members[a] = large
    settle(level)
    return out


def runs_of(ids: np.ndarray, doc: np.ndarray, min_length: int) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document that has any, in this order. ids are at least 1."""
    base = max(1, (min_length + 1) // 2)
    picked = np.isin(doc, repeating(ids, doc, base))
    if not picked.any():
        return {}
    words = np.unique(ids[picked], return_inverse=True)[1] + 1
    names, numbers = np.unique(doc[picked], return_inverse=True)
    begins = np.searchsorted(numbers, np.arange(len(names)))
    out: dict[int, list[tuple[int, int, int]]] = {}
    for i, k, lcp in seeds(*suffix_edges(words, numbers, base)):
        period, d = k - i, numbers[i]
        if lcp + period >= min_length and (i == begins[d] or words[i - 1] != words[k - 1]):
            out.setdefault(int(names[d]), []).append((int(i - begins[d]), lcp + period, period))
    return {d: sorted(found, key=lambda r: (r[0], r[2])) for d, found in out.items()}


def find_runs(docs: DataFrame, text: str = "text", min_length: int = 12, runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """`docs` with the runs of each text, by start and then period, and the text without repetitions.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0. `collapsed` has the words, joined by one blank, but for those that some
    run contains after its first `period` words. A null text has no runs, and an empty `collapsed`; columns of docs that are
    named like the new ones give way to them; rows that repeat are rows of their own.
    """
    others = [c for c in docs.columns if c not in (runs, collapsed)]
    rows = docs.select(*[docs[c] for c in others], docs[text].cast("string").alias("".join(others) + "_"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(len(others))).fill_null(0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GATHER_BYTES, side="right")))
                part = batch.slice(at, to - at)
                found, short = _of_texts(part.column(len(others)).to_pylist(), min_length)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], found, short], [*others, runs, collapsed])
                at = to

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(work, ", ".join([*kinds, f"`{runs}` array<{RUN}>", f"`{collapsed}` string"]))


def _of_texts(texts: list[str | None], min_length: int) -> tuple[pa.Array, pa.Array]:
    words = [(t or "").encode().split() for t in texts]  # bytes are split at ASCII white space
    counts = np.array([len(w) for w in words])
    ids = pa.array([w for of in words for w in of], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    found = runs_of(ids, np.repeat(np.arange(len(words)), counts), min_length)
    short = []
    for d, of in enumerate(words):
        if d in found:
            keep = bytearray(b"\1") * len(of)
            for start, length, period in found[d]:
                keep[start + period : start + length] = bytes(length - period)
            of = compress(of, keep)
        short.append(b" ".join(of))
    flat = np.array([r for d in range(len(words)) for r in found.get(d, ())], dtype=np.int64).reshape(-1, 3)
    offsets = np.cumsum([0] + [len(found.get(d, ())) for d in range(len(words))])
    as_rows = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields=list(_ARROW_RUN))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), as_rows), pa.array(short, pa.binary()).cast(pa.string())


def runs_digest(docs: DataFrame, text: str = "text", min_length: int = 12) -> DataFrame:
    """Of each document doc_id, n_runs, its longest run (start, length, period, exponent_milli; nulls without runs), and
    digests of all runs and of the collapsed text."""
    found = find_runs(docs.select("doc_id", F.col(text).alias("text")), "text", min_length)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).alias("told"), "collapsed")
    length, period = -F.col("top.less"), F.col("top.period")
    return rows.select(
        "doc_id",
        "n_runs",
        F.col("top.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.call_function("div", 1000 * length, period).alias("exponent_milli"),
        F.sha2("told", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
