"""Calendar expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = 86400


def year_of_epoch(seconds: Column) -> Column:
    """UTC calendar year of seconds since 1970, negative values included."""
    return F.year(F.date_from_unix_date(F.floor(seconds / _DAY).cast("int")))


def in_year(when: Column, year: int) -> Column:
    """Half-open range test, which reaches the file scan unlike ``year(when) = y``."""
    return (when >= F.lit(f"{year:04d}-01-01")) & (when < F.lit(f"{year + 1:04d}-01-01"))
