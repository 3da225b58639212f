"""Words of whole Arrow text columns, hashed with numpy, many texts at a time.

A word is a run of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z are lower-cased: ASCII letters and digits and all
non-ASCII characters. As every byte of a non-ASCII character in UTF-8 is above 0x7F, bytes decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # texts are hashed in slices of about this size; a longer text is a slice of its own

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = True
_IS_WORD[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, SLICE_BYTES + 1)
        _POWERS[:] = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: polynomials of the bytes modulo 2^64, then mixed."""
    forth, back = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forth[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts])


@dataclass
class Words:
    """first: index of the first text of the slice in its column. hashes: of all words; bounds[i]:bounds[i + 1] are those of the slice's text i."""

    first: int
    hashes: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i] : self.bounds[i + 1]]


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) of consecutive slices. Null texts count as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def hashed_words(column: pa.Array) -> Iterator[Words]:
    for first, data, offsets in slices(column):
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = _IS_WORD[data]
        begins = inside[1:-1] & ~inside[:-2]
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # a word doesn't run on from one text into the next
        begins[edges] = inside[edges + 1]
        starts = np.flatnonzero(begins)
        stops = inside[1:-1] & ~inside[2:]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        stops[last] = inside[last + 1]
        ends = np.flatnonzero(stops) + 1
        yield Words(first, span_hashes(_LOWER[data], starts, ends), np.searchsorted(starts, offsets))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of `k` consecutive words (none if there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = words[:n].copy()
    for j in range(1, k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[j : j + n]
    return mix(h)
