"""Words and shingles of many texts at once, as numpy arrays over their bytes.

A slice is a run of whole documents of some two megabytes (or one document
that is longer), so temporary arrays stay small whatever the batch. Bytes of
multi-byte characters are all above 0x7F, so classes of ASCII characters can
be told from single bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
SLICE_DOCS = 1 << 15
U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_UNBASE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = U64(0xD6E8FEB86659FD93)

# The two word patterns, as the bytes that belong to a word.
ALPHANUMERIC = np.array([not (b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F) for b in range(256)])
NOT_BLANK = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_column(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(data: np.ndarray, offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First document, end, bytes and own offsets of each slice, of some ``size`` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), first + SLICE_DOCS, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES)
        _powers[:] = [
            np.multiply.accumulate(np.r_[U64(1), np.full(size - 1, base, U64)]) for base in (_BASE, _UNBASE)
        ]
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of a slice in order: byte range, document in the slice, and place in it."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    n_words: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def place(self) -> np.ndarray:
        return np.arange(len(self)) - self.first[self.doc]

    def hashes(self) -> np.ndarray:
        """64 bits of each word's bytes, wherever it stands."""
        n = len(self.data)
        up, down = _power_tables(n + 1)
        total = np.zeros(n + 1, U64)
        np.cumsum((self.data.astype(U64) + U64(1)) * up[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(U64))


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Words:
    """Maximal runs of ``member`` bytes; a run ends where its document ends."""
    n_docs = len(offsets) - 1
    inside = member[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    first = np.searchsorted(start, offsets)
    n_words = np.diff(first)
    return Words(data, start, end, np.repeat(np.arange(n_docs), n_words), n_words, first[:-1])


def run_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words, across documents too."""
    n = max(0, len(word_hashes) - k + 1)
    out = np.zeros(n, U64)
    for j in range(k):
        out *= _STEP
        out += word_hashes[j : j + n]
    return mix(out + U64(k))


class Runs:
    """Hashes of any runs of words, from sums of the hashes before each word."""

    def __init__(self, word_hashes: np.ndarray):
        n = len(word_hashes)
        up, self.down = _power_tables(n + 1)
        self.total = np.zeros(n + 1, U64)
        np.cumsum(word_hashes * up[:n], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(U64))


def shingles_of(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and their documents, in order, repeats kept.

    A document of fewer than ``k`` words, but not none, is one shingle of all
    its words.
    """
    h = words.hashes()
    runs = run_hashes(h, k)
    whole = words.doc[: len(runs)] == words.doc[k - 1 :] if len(runs) else np.zeros(0, bool)
    values, docs = [runs[whole]], [words.doc[: len(runs)][whole]]
    for size in range(1, k):
        short = np.flatnonzero(words.n_words == size)
        if len(short):
            values.append(run_hashes(h, size)[words.first[short]])
            docs.append(short)
    if len(values) == 1:
        return values[0], docs[0]
    doc = np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    return np.concatenate(values)[order], doc[order]
