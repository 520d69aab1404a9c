"""A session for one machine: tests, bench and trials.

On a cluster the submitted configuration is used as it is; the library sets
nothing. README lists the settings that matter there.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "reckoner", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="reckoner-checkpoint-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
