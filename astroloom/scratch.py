"""Folders for tables that a plan writes on its way, shared by the driver and all executors, and deleted when the driver ends."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared(spark: SparkSession) -> str:
    """spark.checkpoint.dir; on a local master without that setting, a temporary folder. RuntimeError on a cluster without it."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not getattr(spark, "_loom_scratch", None):
        spark._loom_scratch = tempfile.mkdtemp(prefix="loom-")
    return spark._loom_scratch


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is there goes when the driver ends, or by drop()."""
    path = f"{shared(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: later plans read the files, and lost executors take nothing with them."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clear() -> None:
    for spark, path in _made:
        with contextlib.suppress(Exception):  # the session may have ended before
            drop(spark, path)
