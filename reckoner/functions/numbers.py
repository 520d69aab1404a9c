"""Number parsing, guarded division and two-decimal formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(col: Column, dtype: str, on_bad: str = "fail") -> Column:
    """Text to number. ``on_bad`` is ``"fail"`` or ``"null"``.

    Does not depend on the session's ANSI setting. NULL stays NULL.
    """
    parsed = col.try_cast(dtype)
    if on_bad == "null":
        return parsed
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    message = F.concat(F.lit(f"not a valid {dtype}: "), col)
    return F.when(col.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def ratio(total: Column, n: Column, default: float | None = None) -> Column:
    """``total / n``; the default (or NULL) where ``n`` is zero."""
    return F.when(n > 0, total / n).otherwise(F.lit(default).cast("double"))


def fixed2_half_up(x: Column) -> Column:
    """Two decimals, rounding half up on the shortest decimal (3.775 -> 3.78)."""
    return F.when(x.isNotNull(), F.format_string("%.2f", x))


def fixed2_binary(x: Column) -> Column:
    """Two decimals of the exact binary value, ties to even (3.775 -> 3.77).

    3.775 is stored slightly below its decimal text, 4.125 exactly. Only when
    the product with 100 falls on a half can its rounding hide on which side
    the exact value lies. The whole part is split off, which is exact, so only
    a fraction is multiplied; both its halves times 100 are exact, and so is
    the error of the product. From 2**63 on, where no double has a fraction,
    and for NaN the platform's text is taken.
    """
    size = F.abs(x)
    whole = F.floor(size)
    part = size - whole.cast("double")
    product = part * 100.0
    high = part.cast("float").cast("double")
    error = (high * 100.0 - product) + (part - high) * 100.0
    hidden = (product - F.floor(product) == 0.5) & (error != 0.0)
    cents = F.when(hidden, F.floor(product) + F.when(error > 0.0, 1).otherwise(0)).otherwise(F.rint(product)).cast("bigint")
    below = (x < 0) | ((x == 0) & x.cast("string").startswith("-"))  # -0.0 has a sign, too
    sign = F.when(below, "-").otherwise("")
    text = F.format_string("%s%d.%02d", sign, whole + F.when(cents == 100, 1).otherwise(0), cents % 100)
    return F.when(x.isNotNull(), F.when(size < 2.0**63, text).otherwise(F.format_string("%.2f", x)))
