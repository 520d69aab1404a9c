"""Lines to rows with a verdict on each: good rows and bad ones from one scan.

Beside failing, dropping and NULL (``sources.text``) this is the fourth rule for
malformed rows: nothing stops, nothing is lost, and what is wrong is kept with its
file and the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from reckoner.functions.numbers import parse_number
from reckoner.functions.text import drop_trailing_empty, split_fields, strip
from reckoner.sources.staging import stage
from reckoner.sources.text import Dialect

PROBLEM = "problem"
FILE = "file"


def read_lines_with_file(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line: ``value`` and the ``file`` that it stands in."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    return lines.select("value", F.col("_metadata.file_path").alias(FILE))


def checked(lines: DataFrame, schema: StructType | str, dialect: Dialect, required: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema``, ``problem`` (NULL for good rows), ``value`` and further columns of ``lines``.

    A row is bad when it has too few fields, when a number is none, or when a
    ``required`` column is empty; the first of these is its problem, and columns
    are looked at from left to right. An empty number is NULL. The rules of ``dialect`` for short rows and
    bad numbers do not apply.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    for name in required:
        if name not in schema.names:
            raise ValueError(f"no column {name}")
    value = F.col("value") if dialect.trailing_empty else drop_trailing_empty(F.col("value"), dialect.sep)
    fields = split_fields(value, dialect.sep, len(schema) if dialect.bounded else None)
    other = [c for c in lines.columns if c != "value"]
    split = lines.select("value", *other, fields.alias("__fields"))

    few = F.coalesce(F.size("__fields"), F.lit(0)) < len(schema)
    problem = F.when(F.col("value").isNull(), "no line").when(few, F.concat(F.lit("fields: "), F.size("__fields").cast("string")))
    columns = []
    for i, field in enumerate(schema):
        text = F.get("__fields", F.lit(i))
        text = strip(text) if dialect.trim else text
        column = text
        if not isinstance(field.dataType, StringType):
            column = parse_number(text, field.dataType.simpleString(), "null")
            problem = problem.when(text.isNotNull() & (text != "") & column.isNull(), f"number: {field.name}")
        if field.name in required:
            problem = problem.when(column.isNull() | (text == ""), f"empty: {field.name}")
        columns.append(column.alias(field.name))
    return split.select(*columns, problem.alias(PROBLEM), "value", *other)


def good_rows(rows: DataFrame, schema: StructType | str) -> DataFrame:
    names = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
    return rows.filter(F.col(PROBLEM).isNull()).select(*names)


def bad_rows(rows: DataFrame) -> DataFrame:
    """Problem, line, and further columns such as its file."""
    other = rows.columns[rows.columns.index("value") + 1 :]
    return rows.filter(F.col(PROBLEM).isNotNull()).select(PROBLEM, "value", *other)


def parse_apart(
    lines: DataFrame, schema: StructType | str, dialect: Dialect, required: Sequence[str] = (), folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad rows. The lines are read once where ``folder`` or the session's folder is there to stage them in."""
    rows = stage(checked(lines, schema, dialect, required), folder)
    return good_rows(rows, schema), bad_rows(rows)
