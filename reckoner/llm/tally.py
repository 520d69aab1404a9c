"""Counts of 64-bit keys, kept in tasks as sorted arrays and moved as packed rows.

A task sums what it reads before anything is shuffled, so a hot key moves as
one entry per task. A packed row holds the entries of one bucket. Buckets are
merged as their rows arrive; a merging task holds distinct keys, not rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PACKED = "bucket int, keys binary, counts binary"
NAMES = ["bucket", "keys", "counts"]
COMPACT_AT, EMIT_AT = 1_500_000, 3_000_000


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


class Tally:
    def __init__(self):
        self.keys, self.counts, self.pending, self.held = [], [], 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        """Add keys with counts, or keys to be counted."""
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts.astype(np.int64))
        self.pending += len(keys)
        if self.pending > max(COMPACT_AT, self.held):
            self.compact()

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) > 1:
            keys, counts = summed(np.concatenate(self.keys), np.concatenate(self.counts))
            self.keys, self.counts = [keys], [counts]
        self.pending, self.held = 0, len(self.keys[0]) if self.keys else 0
        return (self.keys[0], self.counts[0]) if self.keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as differences; counts in four bytes where they fit."""
    steps = np.diff(keys, prepend=np.uint64(0))
    small = counts.max(initial=0) < 1 << 32
    return steps.tobytes(), b"\x04" + counts.astype(np.uint32).tobytes() if small else b"\x08" + counts.tobytes()


def unpack(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(keys, np.uint64), dtype=np.uint64), counts_of(counts)


def counts_of(packed: bytes) -> np.ndarray:
    """The first byte tells the width."""
    return np.frombuffer(packed, np.uint32 if packed[0] == 4 else np.int64, offset=1).astype(np.int64)


def rows_of(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    buckets, keys, counts = [], [], []
    for bucket, k, n in parts:
        packed = pack(k, n)
        buckets.append(bucket)
        keys.append(packed[0])
        counts.append(packed[1])
    return pa.record_batch([pa.array(buckets, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], names=NAMES)


def split(keys: np.ndarray, counts: np.ndarray, bucket_of: Callable) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Entries by bucket, each still sorted."""
    if not len(keys):
        return
    bucket = bucket_of(keys)
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    for b, at in zip(found.tolist(), np.split(order, first[1:]), strict=True):
        yield b, keys[at], counts[at]


def emitted(key_arrays: Iterator[np.ndarray], bucket_of: Callable) -> Iterator[pa.RecordBatch]:
    """Packed rows of all keys that a task counts."""
    tally = Tally()
    for keys in key_arrays:
        tally.add(keys)
        if tally.held > EMIT_AT:
            yield rows_of(split(*tally.compact(), bucket_of))
            tally = Tally()
    yield rows_of(split(*tally.compact(), bucket_of))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tallies: dict[int, Tally] = {}
    for batch in batches:
        for bucket, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            tallies.setdefault(bucket, Tally()).add(*unpack(keys, counts))
    for bucket in list(tallies):
        yield rows_of([(bucket, *tallies.pop(bucket).compact())])


def merged(packed: DataFrame, partitions: int) -> DataFrame:
    """One packed row per bucket."""
    return packed.repartition(partitions, "bucket").mapInArrow(_merge, PACKED)
