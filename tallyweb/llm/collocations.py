"""Phrase collocations by streams of counted phrases in prefix and suffix order.

1. *Windows.* Each word begins a window: itself and up to `max_words` - 1 words after it in its piece. A first pass counts
   words (and pairs and triples, if asked to) in a table of `SLOTS` hashed slots; windows end before one whose slot stays
   under `min_count`, as no phrase that holds it is frequent. The table has a fixed size and only ever lets too much
   through, so results don't depend on it. Tasks sum up equal windows as far as `HELD_ROWS` of them go.
2. *Prefix order.* Windows are dealt by ranges of themselves and sorted, so that a phrase stands right before its
   extensions; one pass gives the counts of all phrases of all lengths, as sums of neighbouring rows. What reaches over
   the edge of a batch of rows is summed up from its parts. No table of phrases is kept anywhere.
3. *Lockstep joins.* Frequent phrases are cut in two; the stream of cuts by their first parts (prefix order), and then by
   their rests (suffix order), is merged with the stream of phrases by sort-merge joins. Counts of the extensions by one
   word are the largest of the longer phrases by their first and last words.

A word is a run of anything but blanks and tabs in a piece; pieces end at `[.,;:!?]` and line ends. A-Z are lower-cased.
Null texts are empty; null langs are `und`; no documents give no rows; rows that repeat count each time. Other columns
aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged
from .words import mix, span_hashes

SLOTS = 1 << 24  # of the tables of counts of words, pairs and triples: 2 MB as bits
HASHES = 2  # tables that the slots are dealt to; a phrase is counted once in each
BLOCKS = 256  # that the table is summed up in
HELD_ROWS = 1 << 19  # windows that a task holds to sum up equal ones
GATHER_BYTES = 2 << 20  # texts are worked on together up to about this size; a longer text is worked on alone
SALTS = 256  # groups that each language's first phrases are chosen in before the last choice

_KIND = np.zeros(256, dtype=np.uint8)  # 0: of a word
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """Words of some texts. `joined` has them one after the other, a zero byte after each; zeros and ones in words are
    escaped, so that byte order of joined words is the order of word sequences."""

    joined: np.ndarray
    at: np.ndarray  # n + 1 places in `joined`
    lang: np.ndarray  # index of each word's language
    langs: list[str]
    linked: list[np.ndarray]  # words; those with the next one in the same piece; those with the next two
    hashes: list[np.ndarray]  # of (language, word), of pairs and of triples, as far as wanted

    def __len__(self) -> int:
        return len(self.lang)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[str]]]:
    """Lower-cased texts and their languages, some at a time."""
    texts: list[bytes] = []
    langs: list[str] = []
    size = 0
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = (text or "").encode().translate(_LOWER)
            if b"\0" in raw or b"\1" in raw:
                raw = raw.replace(b"\1", b"\1\2").replace(b"\0", b"\1\1")
            if texts and size + len(raw) > GATHER_BYTES:
                yield texts, langs
                texts, langs, size = [], [], 0
            texts.append(raw)
            langs.append("und" if lang is None else lang)
            size += len(raw) + 1
    if texts:
        yield texts, langs


def words_of(texts: list[bytes], langs: list[str], hashed: int = 1) -> Words:
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    kind = _KIND[data]
    inside = np.concatenate([[False], kind == 0])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    text_at = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    names = sorted(set(langs))
    number = {name: i for i, name in enumerate(names)}
    lang = np.array([number[x] for x in langs])[np.searchsorted(text_at, starts, side="right") - 1]
    pieces = np.searchsorted(np.flatnonzero(kind == 2), starts)
    near = pieces[1:] == pieces[:-1]
    linked = [np.arange(len(starts)), np.flatnonzero(near), np.flatnonzero(near[1:] & near[:-1])]
    at = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    joined = np.zeros(at[-1], dtype=np.uint8)
    own = np.ones(at[-1], dtype=bool)
    own[at[1:] - 1] = False
    joined[own] = data[inside[1:]]
    of_lang = np.array([zlib.crc32(x.encode()) for x in names], dtype=np.uint64)
    hashes = span_hashes(data, starts, ends)
    grams = [mix(hashes ^ mix(of_lang)[lang])]
    for k in range(1, hashed):  # a gram's hash is that of its first words, and the next one's
        before = np.searchsorted(linked[k - 1], linked[k])
        grams.append(mix(grams[-1][before] * _STEP + hashes[linked[k] + k]))
    return Words(joined, at, lang, names, linked, grams)


def _slots(hashes: np.ndarray, slots: int) -> list[np.ndarray]:
    """The slot of each hash in each of the tables, which lie one after the other; each takes other bits of the hashes."""
    wide = (slots // HASHES).bit_length() - 1
    return [((hashes << np.uint64(i * wide)) >> np.uint64(64 - wide)).astype(np.int64) + (i << wide) for i in range(HASHES)]


def slot_counts(docs: DataFrame, min_count: int, pruned: int = 1, table_size: int = SLOTS) -> DataFrame:
    """(block, counts) of the table of phrases of up to `pruned` words: a row for each block and task; counts end at
    `min_count`."""
    kind = np.min_scalar_type(2 * min_count)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, any_text = np.zeros(table_size, dtype=kind), False
        for texts, langs in _gathered(batches):
            w = words_of(texts, langs, pruned)
            for own in (x for h in w.hashes for x in _slots(h, table_size)):
                slots, n = np.unique(own, return_counts=True)
                table[slots] = np.minimum(table[slots] + np.minimum(n, min_count).astype(kind), min_count)
            any_text = True
        if not any_text:
            return
        blocks = [b.tobytes() for b in np.split(table, BLOCKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array(blocks, pa.binary())], ["block", "counts"])

    return docs.mapInArrow(count, "block int, counts binary")


def frequent_slots(docs: DataFrame, min_count: int, pruned: int = 1, table_size: int = SLOTS) -> np.ndarray:
    """Bits of the slots that reach `min_count`: SLOTS / 8 bytes, whatever the corpus."""
    kind = np.min_scalar_type(2 * min_count)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.zeros(table_size // BLOCKS, dtype=kind)

        def row() -> pa.RecordBatch:
            bits = np.packbits(total >= min_count).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits], pa.binary())], ["block", "bits"])

        for batch in batches:
            for b, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != block:
                    if block is not None:
                        yield row()
                    block, total = b, np.zeros(table_size // BLOCKS, dtype=kind)
                total = np.minimum(total + np.frombuffer(counts, dtype=kind), min_count).astype(kind)
        if block is not None:
            yield row()

    summed = slot_counts(docs, min_count, pruned, table_size).repartition("block").sortWithinPartitions("block").mapInArrow(add_up, "block int, bits binary")
    bits = np.zeros((BLOCKS, table_size // BLOCKS // 8), dtype=np.uint8)
    for r in summed.collect():
        bits[r["block"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return bits.reshape(-1)


def _windows_of(w: Words, bits: np.ndarray, max_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct windows: index of a first word, of the word after the last one, times; and each language's words."""
    n = len(w)

    def passes(hashes: np.ndarray) -> np.ndarray:
        there = np.ones(len(hashes), dtype=bool)
        for slot in _slots(hashes, 8 * len(bits)):
            there &= (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 != 0
        return there

    frequent = []  # whether the phrase of 1, 2, 3 words from each word on may be
    for k, at in enumerate(w.linked):
        frequent.append(np.zeros(n + max_words, dtype=bool))
        frequent[k][at[passes(w.hashes[k])] if k < len(w.hashes) else at] = True
    alive = frequent[0][:n]
    length = alive.astype(np.int64)
    for k in range(1, max_words):
        alive = alive & frequent[0][k : k + n] & frequent[1][k - 1 : k - 1 + n] & (frequent[2][k - 2 : k - 2 + n] if k > 1 else True)
        length += alive
    first = np.flatnonzero(length)
    length = length[first]
    words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(w.at.astype(np.int64)), pa.py_buffer(w.joined)])
    ids = np.zeros(n + max_words, dtype=np.int64)
    ids[:n] = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    many = int(ids.max(initial=0)) + 2
    code = w.lang[first] * many + ids[first] + 1
    for k in range(1, max_words):
        code = np.unique(code, return_inverse=True)[1] * many + np.where(length > k, ids[first + k] + 1, 0)
    _, pick, times = np.unique(code, return_index=True, return_counts=True)
    return first[pick], (first + length)[pick], times, np.bincount(w.lang, minlength=len(w.langs))


def counted_windows(docs: DataFrame, bits: np.ndarray, max_words: int, pruned: int = 1) -> DataFrame:
    """(lang, phrase, n) of the windows, summed up for some texts at a time. The empty phrase counts all words."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def counted(texts: list[bytes], langs: list[str]) -> pa.Table:
        w = words_of(texts, langs, pruned)
        first, after, times, totals = _windows_of(w, shared.value, max_words)
        begin, size = w.at[first], w.at[after] - 1 - w.at[first]
        place = np.concatenate([[0], np.cumsum(size)])
        raw = w.joined[np.repeat(begin - place[:-1], size) + np.arange(place[-1])]
        phrases = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(place.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.string())
        names = pa.array(w.langs, pa.string())
        own = pa.table({"lang": names.take(pa.array(w.lang[first])), "phrase": phrases, "n": pa.array(times, pa.int64())})
        return pa.concat_tables([own, pa.table({"lang": names, "phrase": pa.array([""] * len(names), pa.string()), "n": pa.array(totals, pa.int64())})])

    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by(["lang", "phrase"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select(["lang", "phrase", "n"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for texts, langs in _gathered(batches):
            held.append(counted(texts, langs))
            if sum(len(t) for t in held) > HELD_ROWS:
                held = [summed(held)]
                if len(held[0]) > HELD_ROWS // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from summed(held).to_batches()

    return docs.mapInArrow(windows, "lang string, phrase string, n long")


def phrase_counts(windows: DataFrame, min_count: int) -> DataFrame:
    """(lang, phrase, n_words, a) of the phrases that begin windows at least `min_count` times, and of the empty ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, phrase, n = batch.columns
            words = pc.split_pattern(phrase, "\0")
            begin = words.offsets.to_numpy()
            flat = words.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            begin = begin - begin[0]
            size = np.where(pc.binary_length(phrase).to_numpy(zero_copy_only=False) > 0, np.diff(begin), 0)
            times = n.to_numpy()
            changed = np.append(True, np.diff(lang.dictionary_encode().indices.to_numpy(zero_copy_only=False)) != 0)
            picked = [(np.flatnonzero(size == 0), 0, times[size == 0])]
            for k in range(1, int(size.max()) + 1):
                own = np.where(size >= k, flat[np.minimum(begin[:-1] + k - 1, len(flat) - 1)], -1)
                changed = changed | np.append(True, own[1:] != own[:-1])
                first = np.flatnonzero(changed)
                total = np.add.reduceat(times, first)
                fits = size[first] >= k
                whole = np.ones(len(first), dtype=bool)
                whole[[0, -1]] = False  # a phrase may go on in the batches around
                kept = fits & ((total >= min_count) | ~whole)
                picked.append((first[kept], k, total[kept]))
            rows = np.concatenate([r for r, _, _ in picked])
            order = np.concatenate([np.full(len(r), k) for r, k, _ in picked])
            sums = np.concatenate([t for _, _, t in picked])
            texts = ["\0".join(x.split("\0")[:k]) if k else "" for x, k in zip(phrase.take(pa.array(rows)).to_pylist(), order.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([lang.take(pa.array(rows)), pa.array(texts, pa.string()), pa.array(order, pa.int32()), pa.array(sums, pa.int64())], ["lang", "phrase", "n_words", "a"])

    sorted_windows = windows.repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    parts = sorted_windows.mapInArrow(count, "lang string, phrase string, n_words int, a long")
    return parts.groupBy("lang", "phrase", "n_words").agg(F.sum("a").alias("a")).where((F.col("a") >= min_count) | (F.col("n_words") == 0))


def _part(begin: Column | int, size: Column) -> Column:
    return F.array_join(F.slice("words", begin, size), "\0")


def scored(phrases: DataFrame, drop_percent: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrase_counts(), those within a longer one that is as frequent left out."""
    totals = phrases.where("n_words = 0").select("lang", F.col("a").alias("n"))
    counted = phrases.where("n_words > 0").select("lang", F.col("phrase").alias("of"), F.col("a").alias("c"))
    candidates = phrases.where("n_words > 1").withColumn("words", F.split("phrase", "\\x00"))
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.select("lang", "phrase", "n_words", "a", "k", _part(1, k).alias("head"), _part(k + 1, F.col("n_words") - k).alias("rest"))
    by_prefix = cuts.join(counted.hint("merge").withColumnsRenamed({"of": "head", "c": "l"}), ["lang", "head"])
    by_suffix = by_prefix.join(counted.hint("merge").withColumnsRenamed({"of": "rest", "c": "r"}), ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    over = (F.lit(1000) * F.col("a")).cast("decimal(19,0)") * wide("n")
    score = F.call_function("div", over, wide("l") * wide("r"))
    lowest = by_suffix.join(totals, "lang").withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut")
    )
    # a longer phrase with the words inside is an extension by one word, or holds one that is at least as frequent
    held = F.explode(F.array(_part(1, F.col("n_words") - 1), _part(2, F.col("n_words") - 1)))
    longer = candidates.where("n_words > 2").select("lang", held.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(longer.hint("merge"), ["lang", "phrase"], "left").where(~F.coalesce(F.col("longer") * 100 >= F.col("cut.a") * drop_percent, F.lit(False)))
    shown = F.replace(F.replace(F.replace(F.col("phrase"), F.lit("\0"), F.lit(" ")), F.lit("\1\1"), F.lit("\0")), F.lit("\1\2"), F.lit("\1"))
    return kept.select("lang", shown.alias("phrase"), "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 5, min_count: int = 100, top: int = 2000, drop_percent: int = 100, pruned: int = 3, table_size: int = SLOTS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of 2 to `max_words` words.

    a: times of the phrase, min_count at least. Cut in two, l and r are those of the parts, n the language's words, and
    score floor(1000 * a * n / (l * r)), at the cut with the least (the shortest first part of equals). A phrase inside a
    longer one of up to max_words words, at least drop_percent % as frequent, goes. The order is by score and a, both
    descending, then by phrase in byte order. `pruned`, 1 to 3: phrases of up to so many words are counted beforehand, which
    saves work where the corpus is small beside table_size * min_count, and doesn't change results.
    """
    docs = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    windows = staged(counted_windows(docs, frequent_slots(docs, min_count, pruned, table_size), max_words, pruned), "windows")
    rows = scored(staged(phrase_counts(windows, min_count), "phrases"), drop_percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("place") <= top)
    placed = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return placed.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
