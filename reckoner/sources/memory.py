"""Small in-memory inputs."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def from_values(spark: SparkSession, values: Iterable, column: str, dtype: str = "string") -> DataFrame:
    """A one-column table of the given values.

    Going through Arrow gives a relation whose size Spark knows, so that a
    short list is broadcast; a list of Python rows would count as huge.
    """
    return spark.createDataFrame(pa.table({column: list(values)}), f"{column} {dtype}")
