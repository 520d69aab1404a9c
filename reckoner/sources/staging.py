"""Materialising a result that several later steps read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_staged: list[str] = []
_tables: list[str] = []


def stage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Compute now, write to files, and read them from there.

    The files go to a folder of their own in ``folder`` or in the session's
    ``spark.checkpoint.dir``, which all executors share, so lost executors do
    not lose them. Where neither is given nothing is computed or written, and
    ``df`` itself is returned. ``clean`` removes the files.
    """
    folder = folder or df.sparkSession.conf.get(SETTING, None)
    if folder is None:
        return df
    path = f"{folder.rstrip('/')}/stage-{uuid.uuid4().hex}"
    _staged.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, keys: Sequence[str], folder: str | None = None, buckets: int | None = None) -> DataFrame:
    """Compute now, write as a table bucketed by ``keys``, and read it from there.

    Later joins and aggregates on all of ``keys`` take the buckets as they are:
    the staged side is not shuffled again, and two tables staged alike join
    without any shuffle. The rows are dealt by key before they are written, so
    a bucket is one file. ``buckets`` is the session's number of shuffle
    partitions unless given; fewer than that, and Spark shuffles anyway.

    A bucket is read by one task, so this is for keys that repeat little, such as
    those of dimensions and orders; facts of hot keys go to ``lookup_skewed``.
    ``clean`` removes table and files.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/stage-{uuid.uuid4().hex}" if folder else new_folder(spark, "stage")
    name = f"stage_{path[-32:]}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    _staged.append(path)
    _tables.append(name)
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own, not yet made, in the session's ``spark.checkpoint.dir``.

    Only a session on one machine may leave that unset; the folder is a temporary
    one then.
    """
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='reckoner-')}"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Remove the files of all stages so far; their DataFrames are gone then."""
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    while _staged:
        path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
