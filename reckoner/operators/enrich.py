"""Joins that add dimension columns to a fact table, and the anti join.

No side is broadcast by hint. A dimension's size is only known where it is
used, so Spark's own check decides: it broadcasts below
``spark.sql.autoBroadcastJoinThreshold`` (or, at run time, below the adaptive
threshold) and sort-merge joins beyond it. A hot key on the fact side of a
sort-merge join is split by the adaptive skew join, because the fact is always
the left input of an inner, left or anti join; ``salts`` is for sessions where
that is off, or where the dimension side is not a plain shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """One row per key, so that a lookup never multiplies facts.

    Where a key repeats, the row with the greatest remaining columns wins,
    which does not depend on file or task order.
    """
    rest = [c for c in dim.columns if c != key]
    if not rest:
        return dim.distinct()
    best = dim.groupBy(key).agg(F.max(F.struct(*rest)).alias("__best"))
    return best.select(key, *[F.col(f"__best.{c}").alias(c) for c in rest])


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    defaults: Mapping[str, object] | None = None,
    salts: int = 1,
) -> DataFrame:
    """Add the columns of ``dim``, which holds one row per ``key``.

    Without ``defaults`` facts with no match are dropped. With it they are kept
    and the named columns get their default. ``salts`` > 1 spreads each key of
    the fact over that many join keys and repeats the dimension as often. The
    salt is a hash of the other columns, so a task that runs again salts alike;
    rows that are equal in all columns share a salt.
    """
    keys = [key]
    if salts > 1:
        others = [c for c in fact.columns if c != key] or fact.columns
        fact = fact.withColumn(_SALT, F.pmod(F.xxhash64(*others), F.lit(salts)))
        dim = dim.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        keys.append(_SALT)
    joined = fact.join(dim, keys, "inner" if defaults is None else "left").drop(_SALT)
    for column, default in (defaults or {}).items():
        joined = joined.withColumn(column, F.coalesce(F.col(column), F.lit(default)))
    return joined


def not_listed(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Rows whose ``column`` is not among the values of the one-column ``listed``.

    NULL is kept. Repeats in the list have no effect.
    """
    values = listed.toDF(column)
    return df.join(values, column, "left_anti")
