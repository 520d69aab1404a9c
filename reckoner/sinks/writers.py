"""Distributed writers, and small previews for people."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def bag_text(column: str, df: DataFrame) -> Column:
    """An array of structs as ``{(a,b),(c,d)}``; values are not escaped."""
    names = df.schema[column].dataType.elementType.names
    items = F.transform(
        F.col(column),
        lambda r: F.concat(F.lit("("), F.concat_ws(",", *[_text(r[n]) for n in names]), F.lit(")")),
    )
    return F.concat(F.lit("{"), F.concat_ws(",", items), F.lit("}"))


def _text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def delimited_lines(df: DataFrame, sep: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One ``line`` per row. NULL is empty, nothing is quoted, bags are nested text."""
    fields = [
        bag_text(c, df) if isinstance(df.schema[c].dataType, ArrayType) else _text(F.col(c))
        for c in (columns or df.columns)
    ]
    return df.select(F.concat_ws(sep, *fields).alias("line"))


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the ``line`` column as text; every task writes its own part file."""
    lines.select("line").write.mode(mode).text(path)


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "errorifexists") -> None:
    write_lines(delimited_lines(df, sep), path, mode)


def write_key_value(df: DataFrame, path: str, key: str, value: str, mode: str = "errorifexists") -> None:
    """Tab-separated key and value."""
    write_lines(delimited_lines(df, "\t", [key, value]), path, mode)


def dump(df: DataFrame, rows: int) -> None:
    """Print the first rows without cutting values. All rows: ``table_lines``."""
    df.show(rows, truncate=False)


def table_lines(df: DataFrame) -> DataFrame:
    """All rows as the ``line``s of a bordered table, left-aligned, in the order of ``df``.

    Widths come from one aggregate; the lines are made by the tasks that hold
    the rows. NULL is written out; a column is at least three wide.
    """
    cells = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    least = [max(3, len(c)) for c in df.columns]
    widths = cells.agg(
        F.array(*[F.greatest(F.lit(n), F.coalesce(F.max(F.length(f"_{i}")), F.lit(0))) for i, n in enumerate(least)]).alias("w")
    )

    def line(texts: Sequence[Column], width: Column) -> Column:
        padded = [F.rpad(t, F.get(width, F.lit(i)), F.lit(" ")) for i, t in enumerate(texts)]
        return F.concat(F.lit("|"), F.concat_ws("|", *padded), F.lit("|"))

    bars = F.concat(F.lit("+"), F.array_join(F.transform("w", lambda n: F.repeat(F.lit("-"), n)), "+"), F.lit("+"))
    head = F.array(bars, line([F.lit(c) for c in df.columns], F.col("w")), bars)
    top = widths.select(F.explode(head).alias("line"))
    body = cells.select(line([F.col(c) for c in cells.columns], widths.scalar()).alias("line"))
    return top.unionAll(body).unionAll(widths.select(bars.alias("line")))


def schema_text(df: DataFrame) -> str:
    """The schema as an indented tree."""
    return df.schema.treeString()
