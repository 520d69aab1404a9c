"""Reading nested bags back from the lines that ``sinks.writers`` writes.

A line is ``key;{(a,b),(c,d)}``. Values are not escaped, so a value that holds a
separator makes a line that can be read in several ways. Such lines are refused
with a reason and kept beside the others; nothing is guessed. A value that holds
a whole ``),(`` with the right number of commas and types around it cannot be
told from two tuples.

An empty field is an empty string, or NULL of any other type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

REASON = "reason"

NO_BAG = "no bag"
START_UNSURE = "bag may start in several places"
FIELDS = "tuple with another number of fields"
TYPES = "field of another type"


def _typed(field: Column, kind) -> Column:
    return field if isinstance(kind, StringType) else F.when(field != "", field).try_cast(kind)


def parse_bags(lines: DataFrame, key: str, bag: str, schema: str, sep: str = ";") -> DataFrame:
    """``key``, ``bag`` as an array of ``schema``, the ``line``, and the ``reason`` why it was refused, if it was."""
    fields = StructType.fromDDL(schema).fields
    width = len(fields)
    start = F.instr("line", sep + "{")
    starts = F.size(F.split("line", r"\Q" + sep + r"{\E", -1)) - 1
    text = F.expr(f"substring(line, __start + {len(sep)})")
    inner = F.expr("substring(__bag, 3, length(__bag) - 4)")
    tuples = F.when(F.col("__bag") == "{}", F.array().cast("array<array<string>>")).otherwise(
        F.transform(F.split(inner, r"\),\(", -1), lambda t: F.split(t, ",", -1))
    )
    cut = lines.select("line", start.alias("__start"), starts.alias("__starts")).withColumn("__bag", text)
    cut = cut.withColumn("__tuples", tuples)
    shaped = (F.col("__starts") >= 1) & ((F.col("__bag") == "{}") | F.col("__bag").rlike(r"(?s)^\{\(.*\)\}$"))
    wrong_width = F.exists("__tuples", lambda t: F.size(t) != width)
    wrong_type = F.exists(
        "__tuples",
        lambda t: F.lit(False) if all(isinstance(f.dataType, StringType) for f in fields) else _any_untyped(t, fields),
    )
    reason = (
        F.when(F.col("line").isNull() | ~shaped, NO_BAG)
        .when(F.col("__starts") > 1, START_UNSURE)
        .when(wrong_width, FIELDS)
        .when(wrong_type, TYPES)
    )
    values = F.transform("__tuples", lambda t: F.struct(*[_typed(F.get(t, F.lit(i)), f.dataType).alias(f.name) for i, f in enumerate(fields)]))
    judged = cut.withColumn(REASON, reason)
    good = F.col(REASON).isNull()
    return judged.select(
        F.when(good, F.expr("substring(line, 1, __start - 1)")).alias(key), F.when(good, values).alias(bag), "line", REASON
    )


def _any_untyped(values: Column, fields) -> Column:
    """Whether a field that is not empty cannot be cast."""
    out = F.lit(False)
    for i, f in enumerate(fields):
        value = F.get(values, F.lit(i))
        out = out | ((value != "") & _typed(value, f.dataType).isNull())
    return out
