"""Small derived columns and summaries of objects, tiles and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, sky


def centre_of_name(name: Column) -> tuple[Column, Column]:
    """ra and dec of the tile that a file name speaks of, to six decimals."""
    n = names.numbers_in(name)
    return sky.tile_centre(F.get(n, F.lit(0)), F.get(n, F.lit(1)), 6)


def moved_reference(crpix: Column, from_scale: float = 0.25, to_scale: float = 0.186) -> Column:
    """A header's reference pixel after half a pixel of the other scale is taken off."""
    return crpix - 0.5 * from_scale / to_scale


def flagged(df: DataFrame, key: str, *others: DataFrame, name: str = "known") -> DataFrame:
    """df with a flag: 1 where key stands in one of the others, else 0."""
    every = others[0].select(key)
    for o in others[1:]:
        every = every.union(o.select(key))
    hit = every.where(F.col(key).isNotNull()).distinct().withColumn("_hit", F.lit(1))
    return df.join(hit, key, "left").withColumn(name, F.coalesce("_hit", F.lit(0))).drop("_hit")


def marked_done(catalogue: DataFrame, tiles: DataFrame, flag: str = "cutout") -> DataFrame:
    """catalogue with flag 1 for objects on these tiles; others keep what they had, 0 where they had nothing."""
    done = tiles.select("tile").distinct().withColumn("_done", F.lit(1))
    was = F.col(flag) if flag in catalogue.columns else F.lit(0)
    return catalogue.join(done, "tile", "left").withColumn(flag, F.coalesce("_done", was, F.lit(0))).drop("_done")


def part_of_list(df: DataFrame, order: list[str], start: int, stop: int) -> DataFrame:
    """Rows start to stop (excluded) in order."""
    return df.orderBy(*order).offset(start).limit(max(stop - start, 0))


def shuffled(df: DataFrame, key: list[str], seed: int) -> DataFrame:
    """df in an order that looks random and is the same for the same seed."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key)


def sizes(objects: DataFrame, scale: float, least_bands: int = 3) -> DataFrame:
    """Median and mean of twice the radius re in pixels, over objects in enough bands that have one."""
    some = objects.where((F.col("n_bands") >= least_bands) & (F.col("re") > 0))
    return some.agg((F.median("re") / scale * 2).alias("median"), (F.avg("re") / scale * 2).alias("mean"), F.count("re").alias("n"))


def files_by_tile(files: DataFrame) -> DataFrame:
    """xxx, yyy and files (in order) of files whose name begins with a tile's numbers; others are left out."""
    t = files.withColumn("_t", names.cutout_tile(F.col("name"))).where("_t is not null")
    return t.groupBy(F.col("_t.xxx").alias("xxx"), F.col("_t.yyy").alias("yyy")).agg(F.array_sort(F.collect_list("name")).alias("files"))


def accounted(results: DataFrame) -> DataFrame:
    """One row: tiles in all, made now, there already, failed, and whether none is left. results: status made, there or failed."""
    n = lambda s: F.count_if(F.col("status") == s)
    return results.agg(F.count(F.lit(1)).alias("total"), n("made").alias("made"), n("there").alias("there"), n("failed").alias("failed"), (n("made") + n("there") == F.count(F.lit(1))).alias("complete"))
