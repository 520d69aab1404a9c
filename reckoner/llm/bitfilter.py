"""A Bloom filter of fixed size over 64-bit hashes, built by Spark.

Its bits are set by tasks and merged by an aggregate over 64-bit cells; only
the cells, whose number is fixed by the caller, reach the driver. It stays one
bit a slot, on the driver, in the broadcast and in the tasks. It is a filter
before an exact join, so a full filter costs time, never rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBES = 3
MAX_LOG2_BITS = 27


def log2_bits(n: int) -> int:
    """About 16 bits for each hash, between 8 KB and 16 MB."""
    return min(MAX_LOG2_BITS, max(16, math.ceil(math.log2(16 * max(1, n)))))


def build(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """The filter as 64-bit cells; equal hashes may repeat."""
    probe = [F.shiftrightunsigned(F.col(column), 21 * i).bitwiseAND(F.lit((1 << min(bits, 21)) - 1)) for i in range(PROBES)]
    if bits > 21:  # the upper part of a probe comes from the whole hash
        upper = F.shiftrightunsigned(F.col(column), 64 - (bits - 21)).bitwiseAND(F.lit((1 << (bits - 21)) - 1))
        probe = [p.bitwiseOR(F.shiftleft(upper, 21)) for p in probe]
    slots = hashes.select(F.explode(F.array(*probe)).alias("slot"))
    cells = slots.groupBy(F.shiftrightunsigned("slot", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("word")
    )
    found = cells.toArrow()
    words = np.zeros(max(1, (1 << bits) >> 6), np.uint64)
    words[found["cell"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return words


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Positions of the hashes that may be in the filter."""
    bits = int(len(table) << 6).bit_length() - 1
    low = np.uint64((1 << min(bits, 21)) - 1)
    found = None
    for i in range(PROBES):
        at = found if found is not None else slice(None)
        h = hashes[at]
        slot = (h >> np.uint64(21 * i)) & low
        if bits > 21:
            slot |= (h >> np.uint64(64 - (bits - 21))) << np.uint64(21)
        hit = (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
        found = np.flatnonzero(hit) if found is None else found[hit]
    return found
