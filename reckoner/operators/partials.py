"""Sums and counts kept per file, so that means never read a file twice.

A state folder holds one partition per batch (a file, a day): sum and count of each
key in it. Adding a batch reads that batch alone and replaces its partition, so
a batch that arrives again, or a job that is run again after it failed, counts once.
Means over everything merge the partial rows, one per key and batch; sums and
counts of parts add up to those of the whole, where means do not.

``fold`` merges batches that no longer change into one. It remembers their names,
and a folded batch that arrives again is refused rather than counted twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reckoner.operators.aggregate import TOTAL, VOTES, means_of_totals, totals

BATCH = "batch"
FOLDED = "folded"
_SEP = "\x1f"


class Partials:
    """The state in ``folder`` of the means of ``value`` per ``keys``. ``schema`` types the keys and the sum."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], value: str, schema: str):
        self.spark, self.folder, self.keys, self.value = spark, folder.rstrip("/"), list(keys), value
        self.schema = StructType.fromDDL(f"{schema}, {VOTES} bigint, {FOLDED} string, {BATCH} string")
        if self.schema.names[:-3] != [*self.keys, TOTAL]:
            raise ValueError(f"the schema must name {[*self.keys, TOTAL]}")

    def _exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def rows(self) -> DataFrame:
        """All partial rows: keys, sum, count, and their batch."""
        if not self._exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def _put(self, rows: DataFrame, batch: str, folded: str | None) -> None:
        typed = rows.select(
            *[F.col(f.name).cast(f.dataType) for f in self.schema.fields[:-2]],
            F.lit(folded).cast("string").alias(FOLDED),
            F.lit(batch).alias(BATCH),
        )
        typed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self.folder)

    def _is_folded(self, batch: str) -> bool:
        names = F.split(FOLDED, _SEP)
        return not self.rows().filter(F.array_contains(names, batch)).isEmpty()

    def add(self, df: DataFrame, batch: str) -> None:
        """Count a batch, in place of what it held before. Its name says what it is, such as the file's."""
        if not batch or _SEP in batch:
            raise ValueError(f"not a batch name: {batch!r}")
        if self._is_folded(batch):
            raise ValueError(f"{batch} was folded with others and cannot be replaced")
        # A batch without rows still replaces its partition: a row without keys and votes stands for it.
        none = self.spark.range(1).select(*[F.lit(None).alias(k) for k in self.keys], F.lit(None).alias(TOTAL), F.lit(0).alias(VOTES))
        self._put(totals(df, self.keys, self.value).unionByName(none), batch, None)

    def fold(self, batches: Sequence[str], into: str) -> None:
        """Merge batches into one of a new name. Run again after a failure, it ends alike."""
        if into in batches:
            raise ValueError("a fold needs a name of its own")
        if not self._is_folded(batches[0]):
            old = self.rows().filter(F.col(BATCH).isin(list(batches)))
            merged = old.groupBy(*self.keys).agg(F.sum(TOTAL).alias(TOTAL), F.sum(VOTES).alias(VOTES))
            # In the new batch from here on; the old ones no longer count, even before they are removed.
            self._put(merged, into, _SEP.join(batches))
        for batch in batches:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{BATCH}={_escaped(self.spark, batch)}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def means(self, mean: str, count: str) -> DataFrame:
        """Mean and count per key over all batches."""
        rows = self.rows()
        names = rows.filter(F.col(FOLDED).isNotNull()).select(F.explode(F.split(FOLDED, _SEP)).alias(BATCH)).distinct()
        current = rows.join(names, BATCH, "left_anti")
        return means_of_totals(current, self.keys, mean, count)


def _escaped(spark: SparkSession, batch: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch)
