"""Session builder with the settings the engine expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "astroloom", cores: int | str = "*", partitions: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, spark-submit sets master and sizes."""
    n = partitions or (os.cpu_count() if cores == "*" else int(cores))
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "20000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
