"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckoner.functions.numbers import parse_number


def equal_to(df: DataFrame, column: str, value: str) -> DataFrame:
    """Case-sensitive equality; NULL is dropped."""
    return df.filter(F.col(column) == value)


def more_than(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Strictly more, as a filter after counting."""
    return df.filter(F.col(column) > bound)


def with_support(df: DataFrame, count: str, minimum: int) -> DataFrame:
    """Groups with at least ``minimum`` rows."""
    return df.filter(F.col(count) >= minimum)


def not_empty(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose text is missing or empty."""
    return df.filter(F.col(column) != "")


def parsed_only(df: DataFrame, column: str, dtype: str) -> DataFrame:
    """Replace a text column by its number, dropping rows that do not parse."""
    number = parse_number(F.col(column), dtype, on_bad="null")
    return df.withColumn(column, number).filter(F.col(column).isNotNull())
