"""Bucketing a number by an ordered table of upper bounds."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bucket(NamedTuple):
    label: str
    name: str  # usable inside a column name
    upper: int | None  # None: no upper bound
    inclusive: bool = True


# The two age groupings. They differ at 18 and 35, so both are kept.
FOUR_AGES = (
    Bucket("0-18", "0_18", 18),
    Bucket("18-35", "18_35", 35),
    Bucket("35-50", "35_50", 50),
    Bucket("50+", "50_plus", None),
)
SEVEN_AGES = (
    Bucket("<18", "under_18", 18, inclusive=False),
    Bucket("18-24", "18_24", 24),
    Bucket("25-34", "25_34", 34),
    Bucket("35-44", "35_44", 44),
    Bucket("45-49", "45_49", 49),
    Bucket("50-55", "50_55", 55),
    Bucket("56+", "56_plus", None),
)


def bucket(value: Column, table: Sequence[Bucket]) -> Column:
    """Label of the first bucket whose upper bound holds; NULL for NULL."""
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for b in table:
        if b.upper is None:
            return label.otherwise(F.lit(b.label))
        label = label.when(value <= b.upper if b.inclusive else value < b.upper, b.label)
    return label
