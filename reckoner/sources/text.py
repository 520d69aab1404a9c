"""Delimited text, with explicit rules for malformed rows.

Four dialects are covered by options: fields trimmed or kept, the last field
absorbing extra separators or not, and a row with too few fields dropped,
failing the job, or padded with NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from reckoner.functions.numbers import parse_number
from reckoner.functions.text import drop_trailing_empty, split_fields, strip


@dataclass(frozen=True)
class Dialect:
    """How a line becomes fields.

    ``bounded``: the last field keeps further separators.
    ``trim``: strip blanks and control characters around every field.
    ``trailing_empty``: whether empty fields at the end of a line are fields.
    ``on_short_row``: ``"fail"``, ``"drop"`` or ``"null"``.
    ``on_bad_number``: ``"fail"`` or ``"null"``.
    """

    sep: str = ","
    bounded: bool = False
    trim: bool = False
    trailing_empty: bool = True
    on_short_row: str = "fail"
    on_bad_number: str = "fail"


TRIMMED_STRICT = Dialect(trim=True, trailing_empty=False)
TRIMMED_LENIENT = Dialect(trim=True, trailing_empty=False, on_short_row="drop")
BOUNDED_STRICT = Dialect(bounded=True)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line in ``value``; a file, a folder or a list of both."""
    return spark.read.text(path if isinstance(path, str) else list(path))


def parse_lines(
    lines: DataFrame,
    schema: StructType | str,
    dialect: Dialect,
    min_fields: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Split ``value`` into typed columns by position.

    Only ``columns`` (by default all) are read, so what other fields hold does
    not matter. ``min_fields`` is the fewest fields of a well-formed row, by
    default up to the last one that is read. Fields beyond the schema are
    ignored.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    wanted = [schema.names.index(c) for c in (columns or schema.names)]
    needed = max(wanted) + 1 if min_fields is None else min_fields

    value = F.col("value")
    if not dialect.trailing_empty:
        value = drop_trailing_empty(value, dialect.sep)
    fields = split_fields(value, dialect.sep, len(schema) if dialect.bounded else None)

    if dialect.on_short_row == "drop":
        split = lines.select(fields.alias("fields")).filter(F.size("fields") >= needed)
    elif dialect.on_short_row == "fail":
        short = F.raise_error(F.concat(F.lit(f"fewer than {needed} fields: "), F.col("value")))
        split = lines.select(F.when(F.size(fields) >= needed, fields).otherwise(short).alias("fields"))
    elif dialect.on_short_row == "null":
        split = lines.select(fields.alias("fields"))
    else:
        raise ValueError(f"on_short_row must be 'fail', 'drop' or 'null', not {dialect.on_short_row!r}")

    parsed = []
    for i in wanted:
        field = schema[i]
        column = F.get("fields", F.lit(i))
        if dialect.trim:
            column = strip(column)
        if not isinstance(field.dataType, StringType):
            column = parse_number(column, field.dataType.simpleString(), dialect.on_bad_number)
        parsed.append(column.alias(field.name))
    return split.select(*parsed)


def first_field(lines: DataFrame, column: str, sep: str = "\t") -> DataFrame:
    """Only the first field of every line; a line without separator is that field."""
    return lines.select(F.split_part("value", F.lit(sep), F.lit(1)).alias(column))


def parse_declared(lines: DataFrame, schema: str, sep: str = ";") -> DataFrame:
    """Lines to declared columns, leniently and without quoting.

    Missing fields and bad numbers are NULL, a quote is an ordinary character,
    and extra fields are ignored.
    """
    options = {"sep": sep, "quote": "", "mode": "PERMISSIVE"}
    return lines.select(F.from_csv("value", F.lit(schema), options).alias("row")).select("row.*")
