"""Aggregates of rows that are on their way into an output, without a second pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class SideResults:
    """Named aggregates over the rows of one DataFrame, known once these are written.

    ``watch`` marks the rows; the tasks that write them keep the aggregates,
    and ``values`` gives the merged result after that action. So a job that
    writes all rows and reports their best row or number reads its input once.
    Rows are to be watched after the last shuffle, or what follows must be
    narrow: then each row counts once, also where a lost executor's tasks run again.
    Only aggregates of bounded size belong here: they go through the driver.
    """

    def __init__(self, metrics: Mapping[str, Column]):
        self.metrics = dict(metrics)
        self.seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *[metric.alias(name) for name, metric in self.metrics.items()])

    def values(self) -> dict[str, object]:
        """Waits for the action; it never comes back if there is none."""
        return self.seen.get


def best_metrics(columns: list[str], metric: str, tie_break: str, eligible: Column) -> dict[str, Column]:
    """The ``columns`` of the row that ``rank.best_one`` gives among the eligible rows, as aggregates.

    NULL if there is none. Rows without the metric are never eligible.
    """
    eligible &= F.col(metric).isNotNull()
    order = [(-F.col(metric)).alias("less"), F.col(tie_break).cast("string").alias("tie")]
    first = F.min(F.when(eligible, F.struct(*order, F.struct(*columns).alias("row"))))
    return {c: first["row"][c] for c in columns}
