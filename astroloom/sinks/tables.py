"""Results as files: cutouts by tile, master catalogues, labels, statistics and lists.

Spark's commit takes the place of locks: what a job writes shows as a whole or not
at all. A table that is rewritten from itself gets a new version, a folder beside the
older ones; readers take the latest whole one, so at no moment is there none.

Defined results: an empty frame leaves a sink as it is, but for versioned() and
processed(), which then hold no rows; missing columns are null."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import catalogs, labels

TILE = ["xxx", "yyy"]
VERSION = "version-"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _fs(spark, path)
    return fs.exists(where)


def cutouts(df: DataFrame, path: str, files: int = 1, key: str = "ID") -> None:
    """Write cutouts in a folder for each tile; tiles that df holds are replaced, others stay.

    files: how many tasks share a tile, by hash of key, a file each (fewer where what they hold is small); size it so that a tile's stacks over files suit a task."""
    deal = [*TILE, F.pmod(F.xxhash64(key), F.lit(files))] if files > 1 else TILE
    df.repartition(*deal).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*TILE).parquet(path)


def append(df: DataFrame, path: str, key: list[str]) -> None:
    """Append rows whose key isn't there yet, one for each key. Reads the target's keys; one writer at a time (for several, and without that scan: sinks.logged)."""
    spark = df.sparkSession
    new = df.dropDuplicates(key)
    if exists(spark, path):
        new = catalogs.pending(new, spark.read.parquet(path), key)
    new.write.mode("append").parquet(path)


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of each whole version of a table, the latest last; a folder whose write didn't end is none."""
    where, fs = _fs(spark, path)
    if not fs.exists(where):
        return []
    named = [f.getPath() for f in fs.listStatus(where) if f.getPath().getName().startswith(VERSION)]
    whole = [w for w in named if fs.exists(_fs(spark, f"{w.toString()}/_SUCCESS")[0])]
    return sorted((int(w.getName().removeprefix(VERSION)), w.toString()) for w in whole)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest whole version of a table; None where there is none."""
    found = versions(spark, path)
    return spark.read.parquet(found[-1][1]) if found else None


def versioned(df: DataFrame, path: str, keep: int = 2) -> None:
    """Write df, which may be made from path's current version, as the next version; the last `keep` stay, for those who still read the one before.

    One writer at a time (for several: sinks.logged). What a dead driver left behind is no version and is passed over: numbers go on after it."""
    spark = df.sparkSession
    where, fs = _fs(spark, path)
    taken = [int(f.getPath().getName().removeprefix(VERSION)) for f in fs.listStatus(where) if f.getPath().getName().startswith(VERSION)] if fs.exists(where) else []
    df.write.parquet(f"{path.rstrip('/')}/{VERSION}{max(taken, default=0) + 1}")
    for _, old in versions(spark, path)[:-keep]:
        _delete(spark, old)


def upsert(parts: DataFrame, path: str) -> None:
    """Put rows into a master catalogue, each distinct row once, also when it is made. current() reads it."""
    master = current(parts.sparkSession, path)
    versioned(parts.dropDuplicates() if master is None else catalogs.upsert(master, parts), path)


def tile_catalogue(df: DataFrame, path: str, key: str = "ID") -> None:
    """The objects of tiles without their pixels, the key also as cfis_id, for upsert()."""
    out = df.drop("images").withColumn("cfis_id", F.col(key))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*TILE).parquet(path)


def master_of_cutouts(spark: SparkSession, path: str, size: int = 224) -> DataFrame:
    """Objects of stored cutouts with the bands that their file's path names; pixels aren't read. ra and dec come first."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    kept = rows.drop("images").withColumn("bands", names.bands_of_path(F.input_file_name(), size))
    return kept.select(*leading(kept.columns, ["ra", "dec"]))


def leading(columns: list[str], first: list[str]) -> list[str]:
    return [*(c for c in first if c in columns), *(c for c in columns if c not in first)]


def relabelled(fresh: DataFrame, path: str, columns: list[str]) -> int:
    """Put newer labels into stored cutouts; only tiles in which a label changes are rewritten. Returns how many rows changed."""
    spark = fresh.sparkSession
    stored = spark.read.parquet(path)
    flags = labels.refresh(stored.select("ra", "dec", *TILE, *columns), fresh, columns)
    touched = flags.where("changed").groupBy(*TILE).agg(F.count(F.lit(1)).alias("n"))
    mark = f"{path.rstrip('/')}.labels-{uuid.uuid4().hex}"
    touched.write.parquet(mark)  # a row for each tile, read again below and as a record of what is rewritten
    touched = spark.read.parquet(mark)
    n = touched.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if n:
        own = stored.join(touched.select(*TILE), TILE, "left_semi").withColumns({"_ra": F.col("ra"), "_dec": F.col("dec")})
        new = labels.refresh(own, fresh, columns).withColumns({"ra": F.col("_ra"), "dec": F.col("_dec")})
        new = new.select(*(F.col(c).cast(kind).alias(c) for c, kind in stored.dtypes))
        staged = f"{mark}-rows"
        new.write.parquet(staged)  # a table can't be overwritten while it is read
        cutouts(spark.read.parquet(staged), path)
        _delete(spark, staged)
    _delete(spark, mark)
    return n


def _delete(spark: SparkSession, path: str) -> None:
    where, fs = _fs(spark, path)
    fs.delete(where, True)


def statistics(rows: DataFrame, path: str) -> None:
    """Append rows as CSV; each file has its header, which readers drop."""
    rows.write.mode("append").option("header", True).csv(path)


def processed(catalogue: DataFrame, path: str, name: str, least_bands: int) -> None:
    """<name>_processed with all objects and <name>_processed_complete with those in enough bands, as CSV."""
    catalogue.write.mode("overwrite").option("header", True).csv(f"{path}/{name}_processed")
    catalogue.where(F.col("n_bands") >= least_bands).write.mode("overwrite").option("header", True).csv(f"{path}/{name}_processed_complete")


def name_list(files: DataFrame, path: str, suffix: str = "") -> None:
    """Names of files that end with suffix, a line each, in order."""
    files.where(F.col("name").endswith(suffix)).select("name").orderBy("name").write.mode("overwrite").text(path)
