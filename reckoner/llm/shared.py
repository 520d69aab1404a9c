"""Tables written to the folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Only a session on one machine may leave it unset; it then gets a temporary
    folder, which the session keeps.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or getattr(context, "_reckoner_folder", None)
    if folder is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = context._reckoner_folder = f"file://{tempfile.mkdtemp(prefix='reckoner-shared-')}"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run; not yet created."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into the shared folder and read it from there.

    Cuts the lineage: a lost executor costs its running tasks, not earlier
    steps. Column pruning and filters reach the files.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per session, for functions that run in tasks."""
    context = spark.sparkContext
    if getattr(context, "_reckoner_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="reckoner-package-"), "reckoner.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(path)
    context._reckoner_shipped = True
