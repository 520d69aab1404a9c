"""Text expressions. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including the blank, as Java's trim() strips them.
_CONTROL_AND_BLANK = "".join(chr(c) for c in range(33))
_REGEX_META = set("\\^$.|?*+()[]{}")


def literal_pattern(sep: str) -> str:
    """Regex matching ``sep`` literally, in the form Java splits fastest."""
    return "".join("\\" + c if c in _REGEX_META else c for c in sep)


def strip(col: Column) -> Column:
    """Remove blanks and control characters from both ends."""
    return F.btrim(col, F.lit(_CONTROL_AND_BLANK))


def split_fields(col: Column, sep: str, max_fields: int | None = None) -> Column:
    """Split on a literal separator.

    With ``max_fields`` the last field absorbs the remaining separators;
    without it trailing empty fields are kept.
    """
    return F.split(col, literal_pattern(sep), -1 if max_fields is None else max_fields)


def drop_trailing_empty(col: Column, sep: str) -> Column:
    """Remove separators, of one character, at the end of the text, and so trailing empty fields."""
    if len(sep) != 1:
        raise ValueError(f"a separator of one character is needed, not {sep!r}")
    return F.rtrim(col, F.lit(sep))


def lower_words(col: Column) -> Column:
    """Lower-case and split on the single blank.

    Tabs, line breaks and punctuation stay inside words. Doubled blanks give
    empty strings; ``operators.tokens.explode_words`` removes them.
    """
    return F.split(F.lower(col), " ")


def left_text(col: Column, width: int) -> Column:
    """Cut to ``width`` characters and pad with blanks to that width."""
    return F.rpad(col, width, " ")


def pad_text(col: Column, width: int) -> Column:
    """Pad with blanks to ``width`` characters, never cutting longer text."""
    text = col.cast("string")
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def pad_ascii(col: Column, width: int) -> Column:
    """``pad_text`` for computed ASCII text, which it evaluates only once."""
    return F.format_string(f"%-{width}s", col)
