"""Words of free text and items of separated lists as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckoner.functions.text import lower_words, split_fields


def explode_words(df: DataFrame, text: str, keep: Sequence[str], word: str = "word") -> DataFrame:
    """One row per lower-case word; rows with NULL text give none."""
    words = df.select(*keep, F.explode(lower_words(F.col(text))).alias(word))
    return words.filter(F.col(word) != "")


def explode_list(df: DataFrame, column: str, sep: str, item: str) -> DataFrame:
    """Replace a separated list by one row per item, empty items included."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(split_fields(F.col(column), sep)).alias(item))
