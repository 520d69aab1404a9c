"""Counts, means and conditional means.

All of them keep fixed-width buffers, so Spark plans hash aggregates with a
map-side partial step: a hot key becomes one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckoner.functions.numbers import ratio

TOTAL = "total"
VOTES = "votes"


def totals(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum and count per key, to be looked up or merged further before dividing."""
    return df.groupBy(*keys).agg(F.sum(value).alias(TOTAL), F.count(value).alias(VOTES))


def means_of_totals(df: DataFrame, keys: Sequence[str], mean: str, count: str) -> DataFrame:
    """Merge totals to coarser keys and divide."""
    merged = df.groupBy(*keys).agg(F.sum(TOTAL).alias(TOTAL), F.sum(VOTES).alias(count))
    return merged.filter(F.col(count) > 0).select(*keys, (F.col(TOTAL) / F.col(count)).alias(mean), count)


def mean_count(df: DataFrame, keys: Sequence[str], value: str, mean: str, count: str) -> DataFrame:
    """Mean and count per key; a NULL value is no vote."""
    return df.groupBy(*keys).agg(F.avg(value).alias(mean), F.count(value).alias(count))


def conditional_means(
    df: DataFrame,
    keys: Sequence[str],
    group: str,
    names: Mapping[str, str],
    value: str,
    mean_prefix: str,
    count_prefix: str | None = None,
) -> DataFrame:
    """One mean (and count) column per group label, in one aggregate.

    ``names`` maps each label to its column suffix. Other labels count for
    nothing but still produce the key's row. A label with no row gives NULL.
    """
    aggregates: list[Column] = []
    columns: list[Column] = []
    for label, name in names.items():
        matching = F.when(F.col(group) == label, F.col(value))
        total, count = F.col(f"__{TOTAL}_{name}"), F.col(f"__{VOTES}_{name}")
        aggregates += [F.sum(matching).alias(f"__{TOTAL}_{name}"), F.count(matching).alias(f"__{VOTES}_{name}")]
        columns.append(ratio(total, count).alias(mean_prefix + name))
        if count_prefix is not None:
            columns.append(count.alias(count_prefix + name))
    return df.groupBy(*keys).agg(*aggregates).select(*keys, *columns)


def count_of(df: DataFrame, keys: Sequence[str], counted: str, count: str) -> DataFrame:
    """Rows per key whose ``counted`` column is not NULL."""
    return df.groupBy(*keys).agg(F.count(counted).alias(count))


def row_count(df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


def distinct_values(column: str) -> Column:
    """Aggregate: number of distinct values, NULL being one of them."""
    has_null = F.max(F.when(F.col(column).isNull(), 1).otherwise(0))
    return F.count_distinct(F.col(column)) + F.coalesce(has_null, F.lit(0))


def as_metrics(one_row: DataFrame, names: Sequence[str]) -> DataFrame:
    """Turn a one-row result into rows (metric, total)."""
    return one_row.unpivot([], list(names), "metric", "total")
