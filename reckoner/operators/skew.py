"""A lookup that finds the hot keys of the fact table itself.

A frequent-items sketch over the key, one pass over one column with a partial
sketch per task, names the keys that hold more than a share of all rows. Only
these are salted, each into as many parts as keep a part below that share, and
only their dimension rows are copied, as often. All other keys join plainly.

The list is bounded by the share whatever the table's size (``2 / share`` keys at
most) and enters both sides as a scalar subquery: the fact is not shuffled to
learn of it. The sketch decides only where rows go, so its error, below a third of
the share, costs balance and never rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"
# Items that the sketch tracks for each one that it may report.
_TRACKED = 16


def hot_keys(fact: DataFrame, key: str, share: float) -> DataFrame:
    """One row per key with about ``share`` of all rows or more: ``key``, ``rows`` (estimated), ``parts``.

    NULL is not among them, as it finds nothing in a lookup.
    """
    if not 0 < share < 1:
        raise ValueError(f"share must be between 0 and 1, not {share}")
    most = math.ceil(2 / share)
    sketch = F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(_TRACKED * most))
    one = fact.agg(F.count(F.lit(1)).alias("total"), sketch.alias("top"))
    items = one.select("total", F.explode("top").alias("t")).select("total", F.col("t.item").alias(key), F.col("t.count").alias("rows"))
    hot = items.filter((F.col("rows") >= share * F.col("total")) & F.col(key).isNotNull())
    return hot.select(key, "rows", F.ceil(F.col("rows") / (share * F.col("total"))).cast("long").alias("parts"))


def _parts(hot: DataFrame, key: str) -> Column:
    """The parts of a row's key: one where it is not hot."""
    entries = F.collect_list(F.struct(F.col(key), F.col("parts")))
    by_key = hot.agg(F.map_from_entries(entries)).scalar()
    return F.coalesce(F.element_at(by_key, F.col(key)), F.lit(1).cast("long"))


def spread(fact: DataFrame, hot: DataFrame, key: str, null_parts: int) -> DataFrame:
    """Facts with the part of their key that they go to."""
    others = [c for c in fact.columns if c != key] or fact.columns
    parts = F.when(F.col(key).isNull(), F.lit(null_parts).cast("long")).otherwise(_parts(hot, key))
    return fact.withColumn(_SALT, F.when(parts > 1, F.pmod(F.xxhash64(*others), parts)).otherwise(0))


def copied(dim: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Dimension rows, those of hot keys once for each part."""
    first = F.lit(0).cast("long")
    return dim.filter(F.col(key).isNotNull()).withColumn(_SALT, F.explode(F.sequence(first, _parts(hot, key) - 1)))


def lookup_skewed(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    defaults: Mapping[str, object] | None = None,
    share: float = 0.01,
) -> DataFrame:
    """``enrich.lookup`` with hot keys found and spread. ``dim`` holds one row per ``key``, of the type of the fact's.

    The part of a fact row is a hash of its other columns, so a task that runs
    again deals alike; rows that are equal in all columns share a part. Facts whose
    key is NULL find nothing and are spread over ``1 / share`` parts.
    """
    hot = hot_keys(fact, key, share)
    salted = spread(fact, hot, key, math.ceil(1 / share))
    joined = salted.join(copied(dim, hot, key), [key, _SALT], "inner" if defaults is None else "left").drop(_SALT)
    for column, default in (defaults or {}).items():
        joined = joined.withColumn(column, F.coalesce(F.col(column), F.lit(default)))
    return joined
