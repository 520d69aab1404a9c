"""Best of all, best with ties, top k per group and ranking of a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def best_one(df: DataFrame, metric: str, tie_break: str) -> DataFrame:
    """The row with the greatest metric; ties go to the first ``tie_break`` as text."""
    return df.orderBy(F.desc(metric), F.col(tie_break).cast("string")).limit(1)


def best_with_ties(df: DataFrame, metric: str) -> DataFrame:
    """All rows that hold the greatest metric.

    The maximum is a scalar, so tied rows stay where they are: no window over
    the whole table and no join.
    """
    return df.filter(F.col(metric) == df.agg(F.max(metric)).scalar())


def top_k_per_group(
    df: DataFrame, groups: Sequence[str], metric: str, tie_break: str, k: int, rank: str = "rank"
) -> DataFrame:
    """The k greatest rows of each group, numbered from 1.

    Spark trims every task to k rows per group before the shuffle, so a group
    holding a third of the rows still arrives as k rows per task.
    """
    order = Window.partitionBy(*groups).orderBy(F.desc(metric), F.col(tie_break))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def nest_top_k(top: DataFrame, group: str, columns: Sequence[str], name: str, rank: str = "rank") -> DataFrame:
    """One row per group holding its ranked rows as an array, at most k long."""
    ranked = F.sort_array(F.collect_list(F.struct(rank, *columns)))
    items = F.transform(ranked, lambda r: F.struct(*[r[c].alias(c) for c in columns]))
    return top.groupBy(group).agg(items.alias(name))


def rank_all(df: DataFrame, descending: Sequence[str], rank: str = "rank", ranges: int = 200) -> DataFrame:
    """Competition rank (1, 2, 2, 4) over the whole table, without one big task.

    Equal values share a rank, so only the distinct values are ordered, each
    with its number of rows. Their ranges are cut at approximate quantiles of
    the first column, a scalar subquery, so a value's range depends on nothing
    else. A range's offset is the rows of all greater ranges; there are at most
    ``ranges`` offsets.
    """
    order = [F.desc(c) for c in descending]
    values = df.groupBy(*descending).agg(F.count(F.lit(1)).alias("__rows"))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = values.agg(F.percentile_approx(descending[0], shares, F.lit(20 * ranges))).scalar()
    above = F.size(F.filter("__cuts", lambda c: c > F.col(descending[0])))
    ranged = values.withColumn("__cuts", cuts).select(
        *descending, "__rows", F.when(F.col(descending[0]).isNull(), ranges).otherwise(above).alias("__part")
    )

    earlier_parts = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__part")
        .agg(F.sum("__rows").alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(earlier_parts), F.lit(0)).alias("__before"))
    )
    earlier_rows = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    position: Column = F.lit(1) + F.col("__before") + F.coalesce(F.sum("__rows").over(earlier_rows), F.lit(0))
    ranked = ranged.join(offsets, "__part").select(*descending, position.alias(rank))

    left, right = df.alias("l"), ranked.alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in descending]
    return left.join(right, same).select("l.*", f"r.{rank}")


def ntile_all(df: DataFrame, descending: Sequence[str], tiles: int, tile: str = "tile", ranges: int = 200) -> DataFrame:
    """Tile 1 to ``tiles`` of every row of the whole table, greatest rows first, without one big task.

    Sizes are those of SQL's ``ntile``: they differ by one at most, greater
    tiles first. Equal rows share the tile of the first of them, so reruns agree.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    placed = rank_all(df, descending, "__rank", ranges).withColumn("__total", total)
    before, size, rest = F.col("__rank") - 1, F.expr(f"__total div {tiles}"), F.col("__total") % tiles
    longer = rest * (size + 1)
    placed = placed.select("*", before.alias("__before"), size.alias("__size"), rest.alias("__rest"), longer.alias("__longer"))
    number = F.expr(
        "CASE WHEN __before < __longer THEN __before div (__size + 1)"
        " ELSE __rest + (__before - __longer) div greatest(__size, 1) END"
    )
    return placed.select(*df.columns, (number + 1).cast("int").alias(tile))


def by_text_key(df: DataFrame, key: str) -> DataFrame:
    """Sorted by the key as text, so that 10 comes before 9."""
    return df.orderBy(F.col(key).cast("string"))
