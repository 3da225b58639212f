"""Packing by power-of-two decomposition: each document is cut into pieces of binary lengths, and pieces of one length
are one bucket of sequences. As a piece is a sequence, none crosses documents and none is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import slices, span_hashes

MAX_TOKENS = 2048
END_ID = 1
PLACE_BITS = 33  # of a sequence's number within its partition
CACHE_WORDS = 1_500_000  # of a worker; beyond that its cache starts anew

# Byte classes that decide where a text may be cut without changing its tokens
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[33:48] = _SYMBOL[58:65] = _SYMBOL[91:97] = _SYMBOL[123:127] = True
_SYMBOL[39] = False  # an apostrophe may join what follows
_SPACE, _BREAK = 32, 10
_FIRM = np.zeros(256, dtype=bool)  # ASCII that isn't blank
_FIRM[33:127] = True
_LATIN_LEAD = 0xC3  # first byte of U+00C0 to U+00FF, of which all but two are letters
_LATIN_SIGNS = (0x97, 0xB7)
_LEADS = np.zeros(256, dtype=bool)  # first bytes of two-byte characters beyond those blanks that have two bytes
_LEADS[0xC3:0xE0] = True


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of chunks. A byte-level BPE of this kind splits a text first, and always: before a space, and before and
    after a line feed, with characters that aren't blank on either side; and between a letter and a symbol. A cut is made
    where few bytes show such a place."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    x = np.concatenate([np.zeros(2, dtype=np.uint8), data, np.zeros(2, dtype=np.uint8)])
    here, before, before2, after = x[2:-2], x[1:-3], x[:-4], x[3:-1]
    firm_after = _FIRM[after] | _LEADS[after]
    firm_before = _FIRM[before] | ((before >= 128) & _LEADS[before2])
    lone = ((here == _SPACE) | (here == _BREAK)) & firm_before & firm_after
    latin = (here == _LATIN_LEAD) & (after != _LATIN_SIGNS[0]) & (after != _LATIN_SIGNS[1])
    latin_before = (before2 == _LATIN_LEAD) & (before != _LATIN_SIGNS[0]) & (before != _LATIN_SIGNS[1])
    cut = lone.copy()
    cut[1:] |= (lone & (here == _BREAK))[:-1]
    cut |= (_LETTER[before] | latin_before) & _SYMBOL[here]
    cut |= _SYMBOL[before] & (_LETTER[here] | latin)
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


class ChunkTokenizer:
    """Tokens of texts from those of their distinct chunks, which are kept: most chunks are words seen before."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # sorted hashes of known chunks
        self.at = np.zeros(0, dtype=np.int64)  # where their tokens begin
        self.sizes = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _learn(self, data: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Chunks without a blank but a space in front are encoded many together, a line feed, always a token of its own,
        between them."""
        chunks = [data[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        plain = [len(c) > 1 and len(c.split()) == 1 and not c[1].isspace() and not c[-1].isspace() and (c[0] == " " or not c[0].isspace()) for c in chunks]
        together, alone = np.flatnonzero(plain), np.flatnonzero(~np.array(plain, dtype=bool))
        ids, sizes = [], []
        for lo in range(0, len(together), 1000):
            some = together[lo : lo + 1000].tolist()
            got = self.tokenizer.encode_batch_fast(["\n".join([chunks[i] for i in some])], add_special_tokens=False)[0].ids
            got = np.asarray(got, dtype=np.uint32)
            feeds = np.flatnonzero(got == self.feed)
            if len(feeds) != len(some) - 1:
                raise ValueError("a line feed isn't a token of its own")
            ids.append(got[got != self.feed])
            sizes.append(np.diff(np.concatenate([[-1], feeds, [len(got)]])) - 1)
        for e in self.tokenizer.encode_batch_fast([chunks[i] for i in alone], add_special_tokens=False):
            ids.append(np.asarray(e.ids, dtype=np.uint32))
            sizes.append(np.array([len(e.ids)]))
        order = np.concatenate([together, alone])
        size = np.empty(len(chunks), dtype=np.int64)
        at = np.empty(len(chunks), dtype=np.int64)
        size[order] = np.concatenate(sizes)
        at[order] = len(self.ids) + np.cumsum(size[order]) - size[order]
        self.ids = np.concatenate([self.ids, *ids])
        place = np.searchsorted(self.keys, hashes)
        self.keys, self.at, self.sizes = (np.insert(old, place, values) for old, values in ((self.keys, hashes), (self.at, at), (self.sizes, size)))

    def one(self, text: bytes) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all texts, their bounds)"""
        starts = _cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > CACHE_WORDS:
            self._forget()
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        missing = np.flatnonzero(~known)
        if len(missing):
            self._learn(data.tobytes(), distinct[missing], starts[first[missing]], ends[first[missing]])
            place = np.searchsorted(self.keys, distinct)
        sizes = self.sizes[place][inverse]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.at[place][inverse] - bounds[:-1], sizes) + np.arange(bounds[-1])]
        return ids, bounds[np.searchsorted(starts, offsets)]


def piece_lengths(n: int, most: int = MAX_TOKENS) -> np.ndarray:
    """`most` as often as it goes, then the powers of two of the rest, from the largest."""
    rest = n % most
    return np.array([most] * (n // most) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1], dtype=np.int64)


_tokenizers: dict[str, ChunkTokenizer] = {}


def pack(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, start, length, tokens, ids_crc32, doc_tokens, bucket, place, sequence_id, offset.

    A document's tokens are its text's, without special ones added, then `end_id`; so a null or empty text is one piece of
    one token. The pieces are cut in order, from the longest. Each is a sequence of its own, of a power of two tokens up to
    `max_tokens` (a power of two itself). `bucket` is that length and `place` the sequence's number among those of its bucket:
    counted from 0 within each partition, whose number stands in the bits from the 33rd on. Batches are filled from one
    bucket, in order of place; sequence_id tells bucket and place. Rows with the same or a null doc_id are documents of
    their own; no rows give no rows. Columns other than doc_id and text are left out. There is no shuffle.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("place", T.LongType()),
        ]
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _tokenizers:
            _tokenizers[tokenizer_path] = ChunkTokenizer(tokenizer_path)
        tokenizer = _tokenizers[tokenizer_path]
        places = dict.fromkeys((1 << b for b in range(max_tokens.bit_length())), TaskContext.get().partitionId() << PLACE_BITS)
        for batch in batches:
            doc_ids = batch.column(0)
            for first, data, offsets in slices(batch.column(1)):
                ids, bounds = tokenizer.encode(data, offsets)
                blob_of_all = data.tobytes()
                held = any(t in blob_of_all for t in tokenizer.added)  # such strings are tokens across the chunks
                row, start, length, blob, crc, total, place = [], [], [], [], [], [], []
                for i in range(len(offsets) - 1):
                    own = ids[bounds[i] : bounds[i + 1]]
                    if held and any(t in (text := blob_of_all[offsets[i] : offsets[i + 1]]) for t in tokenizer.added):
                        own = tokenizer.one(text)
                    own = np.append(own, np.uint32(end_id)).astype("<u4").tobytes()
                    n, at = len(own) // 4, 0
                    for size in piece_lengths(n, max_tokens).tolist():
                        piece = own[4 * at : 4 * (at + size)]
                        row.append(first + i), start.append(at), length.append(size), blob.append(piece), crc.append(zlib.crc32(piece)), total.append(n), place.append(places[size])
                        places[size] += 1
                        at += size
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(blob, pa.binary()), pa.array(crc, pa.int64()), pa.array(total, pa.int64()), pa.array(place, pa.int64())],
                    names=schema.names,
                )

    out = docs.select("doc_id", "text").mapInArrow(pieces, schema)
    sequence = F.shiftleft("place", 5).bitwiseOR(F.log2("length").cast("long"))
    return out.select("*", F.col("length").alias("bucket"), sequence.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def pack_digest(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The pieces of pack(), which says how odd rows are taken, without their tokens."""
    return pack(docs, tokenizer_path, max_tokens).drop("tokens")
