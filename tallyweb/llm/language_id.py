"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are reduced to their letters in lower case, words parted by one blank. All n-grams of 1 to `orders` characters, with
the blanks at both ends of words, are hashed into buckets. Training counts them over all labelled rows: tasks add up
matrices of (language, bucket) and give their entries, Spark sums those up. The matrix of log probabilities is broadcast;
its size is bounded (`MOST_BYTES`), as the number of buckets follows from that of languages. Scoring works on many texts at
a time: their n-grams' buckets are one sparse matrix (rows of buckets, one entry an n-gram), and its product with the
matrix of log probabilities is a gather and a sum by rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = 3
BUCKETS = 1 << 15
MOST_BYTES = 64 << 20  # of the matrix of log probabilities
GATHER_CHARS = 1 << 20  # texts are worked on together up to about this size; a longer text is worked on alone
UNKNOWN = "und"

_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class LanguageModel:
    langs: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # language by bucket
    orders: int = ORDERS


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: whether it is a letter or a mark within a word, and its lower case where that is one character."""
    kinds = [unicodedata.category(chr(c)) for c in range(0x110000)]
    letters = np.array([2 if k[0] == "L" else 1 if k[0] == "M" else 0 for k in kinds], dtype=np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(np.array([k in ("Lu", "Lt") for k in kinds])).tolist():
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
    return letters, lower


def _gathered(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts."""
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and size + n > GATHER_CHARS:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def buckets_of(texts: list[str | None], buckets: int, orders: int = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all n-grams, text by text; n + 1 places where the texts' own begin). Texts without a letter have none."""
    letters, lower = _tables()
    joined = "\n".join(t or "" for t in texts) + "\n"
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = letters[chars]
    text_of = np.repeat(np.arange(len(texts)), [len(t or "") + 1 for t in texts])
    chars = np.where(kind > 0, lower[chars], 32).astype(np.uint64)
    # one blank before each text and after each word
    keep = (kind > 0) | np.append(False, kind[:-1] > 0)
    keep |= np.append(True, text_of[1:] != text_of[:-1])
    has = np.bincount(text_of[kind == 2], minlength=len(texts)) > 0
    keep &= has[text_of]
    # the first character of a text may be a letter itself: a blank is put in front of it
    chars, text_of, kept_kind = chars[keep], text_of[keep], kind[keep]
    begins = np.append(True, text_of[1:] != text_of[:-1])[: len(chars)]
    front = np.flatnonzero(begins & (kept_kind > 0))
    chars, text_of = np.insert(chars, front, 32), np.insert(text_of, front, text_of[front])
    n = len(chars)
    parts, owners = [], []
    h = np.zeros(n, dtype=np.uint64)
    for k in range(min(orders, n)):
        m = n - k
        h = (h[:m] ^ (chars[k:] + np.uint64(1))) * _STEP
        h ^= h >> np.uint64(29)
        fits = text_of[:m] == text_of[k:]
        if k == 0:
            fits &= chars != 32
        parts.append(((h * _STEP) >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int32)[fits])
        owners.append(text_of[:m][fits])
    if not parts:
        return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
    places = [np.searchsorted(o, np.arange(len(texts) + 1)) for o in owners]
    starts = np.sum(places, axis=0)
    out = np.empty(starts[-1], dtype=np.int32)
    for k, (part, place) in enumerate(zip(parts, places, strict=True)):
        # of each text first the shorter n-grams
        before = np.sum([np.diff(p) for p in places[:k]], axis=0) if k else np.zeros(len(texts), dtype=np.int64)
        out[np.repeat(starts[:-1] + before - place[:-1], np.diff(place)) + np.arange(len(part))] = part
    return out, starts


def bucket_counts(labelled: DataFrame, langs: list[str], buckets: int, orders: int = ORDERS) -> DataFrame:
    """(lang index, bucket, n) over rows (text, lang); bucket -1 has the number of texts with a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {x: i for i, x in enumerate(langs)}
        total = np.zeros((len(langs), buckets + 1), dtype=np.int64)
        for batch in batches:
            texts, names = (c.to_pylist() for c in batch.columns)
            for at, to in _gathered(texts):
                found, starts = buckets_of(texts[at:to], buckets, orders)
                own = np.array([number[x] for x in names[at:to]])
                sizes = np.diff(starts)
                row = np.repeat(own, sizes)
                for lang in np.unique(own).tolist():
                    total[lang, :buckets] += np.bincount(found[row == lang], minlength=buckets)
                    total[lang, buckets] += np.count_nonzero(sizes[own == lang])
        lang, bucket = np.nonzero(total)
        n = total[lang, bucket]
        bucket = np.where(bucket == buckets, -1, bucket)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in ((lang, pa.int32()), (bucket, pa.int32()), (n, pa.int64()))], ["lang", "bucket", "n"])

    parts = labelled.mapInArrow(count, "lang int, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train_languages(labelled: DataFrame, text: str = "text", lang: str = "lang", orders: int = ORDERS, buckets: int = BUCKETS, smoothing: float = 0.5) -> LanguageModel:
    """Counts all rows with a language. Their number of languages, at most MOST_BYTES / 4096, comes to the driver, as does
    the matrix; with many languages there are fewer buckets, so that it stays under MOST_BYTES."""
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang IS NOT NULL")
    most = MOST_BYTES // 4096
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().limit(most + 1).collect())
    if len(langs) > most:
        raise ValueError(f"more than {most} languages: is it the right column?")
    while len(langs) * buckets * 4 > MOST_BYTES:
        buckets //= 2
    counts = np.zeros((len(langs), buckets + 1))
    if langs:
        found = bucket_counts(rows, langs, buckets, orders).toPandas()
        counts[found["lang"], found["bucket"]] = found["n"]
    texts = counts[:, buckets] + smoothing
    counts = counts[:, :buckets] + smoothing
    log_prob = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    return LanguageModel(langs, np.log(texts / texts.sum()) if langs else texts, log_prob, orders)


def predict(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Languages and their probabilities; UNKNOWN with 0 of texts without a letter, or without a model."""
    langs, scores = [], []
    for at, to in _gathered(texts):
        n = to - at
        found, starts = buckets_of(texts[at:to], model.log_prob.shape[1] if model.langs else BUCKETS, model.orders)
        known = np.diff(starts) > 0
        if not model.langs or not known.any():
            langs += [UNKNOWN] * n
            scores.append(np.zeros(n))
            continue
        first = starts[:-1][known]
        sums = np.stack([np.add.reduceat(of[found], first, dtype=np.float64) for of in model.log_prob], axis=1) + model.log_prior
        best = sums.argmax(axis=1)
        score = np.zeros(n)
        score[known] = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        names = np.full(n, UNKNOWN, dtype=object)
        names[known] = np.array(model.langs, dtype=object)[best]
        langs += names.tolist()
        scores.append(score)
    return langs, np.concatenate(scores) if scores else np.zeros(0)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the language of each text and its probability among those learned (ties to the first in code-point order).

    `und` with a score of 0 if a text is null or has no letter, or nothing was learned. Whole texts are read. Columns that
    are named like the new ones give way to them; rows that repeat are rows of their own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c not in (lang_pred, score)]
    rows = docs.select(*[docs[c] for c in others], docs[text].cast("string").alias("".join(others) + "_"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = predict(batch.column(len(others)).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*others, lang_pred, score])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(work, ", ".join([*kinds, f"`{lang_pred}` string", f"`{score}` double"]))


def languages_digest(docs: DataFrame, held_out: Column) -> DataFrame:
    """Of each document doc_id, held_out (false where null), lang_pred and score, learned from the rows that aren't held out."""
    rows = docs.select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = train_languages(docs.where(~held_out).select("text", "lang"))
    return identify(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
