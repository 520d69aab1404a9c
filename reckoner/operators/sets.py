"""Bag operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, matched by column name; repeats are kept."""
    return reduce(DataFrame.unionByName, parts)
