"""Numbers of distinct values that merge: a sketch per day, source or file.

Exact distinct counts of parts do not add up, so a count over all parts has to
read them all again. A HyperLogLog sketch of each part does merge, and merging
one twice changes nothing, so a file that arrives twice counts once. Sketches
have a fixed size, 2 ** ``LG_K`` buckets, whatever they count; a hot key is one
sketch per task before the shuffle.

NULL is one more value, as in ``distinct_values``: a flag beside the sketch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH = "sketch"
HAS_NULL = "has_null"
LG_K = 14


def error_bound(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Relative error that merged sketches stay within, at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def sketches(df: DataFrame, keys: Sequence[str], column: str, lg_k: int = LG_K) -> DataFrame:
    """One sketch of the distinct values of ``column`` per key; to be stored, or merged at once."""
    text = F.col(column).cast("string")
    return df.groupBy(*keys).agg(
        F.hll_sketch_agg(text, F.lit(lg_k)).alias(SKETCH), F.coalesce(F.max(F.col(column).isNull()), F.lit(False)).alias(HAS_NULL)
    )


def merged(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser keys, or of everything, from those of parts."""
    return parts.groupBy(*keys).agg(
        F.hll_union_agg(SKETCH).alias(SKETCH), F.coalesce(F.max(HAS_NULL), F.lit(False)).alias(HAS_NULL)
    )


def estimates(parts: DataFrame, name: str) -> DataFrame:
    """The estimated number of distinct values in place of the sketch."""
    value = F.coalesce(F.hll_sketch_estimate(SKETCH), F.lit(0)) + F.col(HAS_NULL).cast("long")
    return parts.select(*[c for c in parts.columns if c not in (SKETCH, HAS_NULL)], value.alias(name))
