"""Connected components of an edge table by alternating large and small stars.

Every step is a minimum per node and a plain join, so a hub's edges are summed
before they are moved and its join may be split. Steps are written to the
shared folder; only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckoner.llm.shared import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "stars")
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "stars")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """``u`` and the least node ``v`` of its component, for every node but the least ones. Edges: ``u``, ``v``."""
    edges = written(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(edges)
    while True:
        edges = written(_small_star(written(_large_star(edges), "edges")), "edges")
        now = _state(edges)
        if now == before:
            return edges
        before = now
