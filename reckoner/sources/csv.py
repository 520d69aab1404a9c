"""Semicolon-separated files, with a declared schema or a header row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reckoner.functions.numbers import parse_number


def read_declared(spark: SparkSession, path, schema: StructType | str, sep: str = ";") -> DataFrame:
    """No header and no quoting; missing fields and bad numbers are NULL."""
    return spark.read.schema(schema).options(sep=sep, quote="", mode="PERMISSIVE").csv(path)


def read_with_header(spark: SparkSession, path, sep: str = ";", infer: bool = True) -> DataFrame:
    """Header row. Types are inferred, which reads the file once more, or all columns are text."""
    return spark.read.options(header=True, sep=sep, inferSchema=infer).csv(path)


def read_named(
    spark: SparkSession, path, columns: Mapping[str, tuple[str, str]], sep: str = ";", on_bad: str = "fail"
) -> DataFrame:
    """Named columns of a file with a header row: file name to (name, type).

    Columns are found by the header, whatever their order. An empty field is
    NULL. A field that is not of its type fails the job, or is NULL with
    ``on_bad="null"``.
    """
    text = read_with_header(spark, path, sep, infer=False)
    return text.select(
        *[
            (F.col(old) if kind == "string" else parse_number(F.col(old), kind, on_bad)).alias(new)
            for old, (new, kind) in columns.items()
        ]
    )
