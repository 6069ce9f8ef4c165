"""Which tiles there are in which filter bands.

Tables are long: a row (xxx, yyy, band) for each tile of a band. They are made
distinct once; counts are sums of map-side partial sums."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TILE = ["xxx", "yyy"]


def registry(spark: SparkSession, bands: list[dict]) -> DataFrame:
    """The band registry as a table; the order of the list is the band axis of stacks."""
    rows = [(k, b["band"], b.get("name", b["band"]), b.get("suffix", ""), b.get("delimiter", "."), int(b.get("fits_ext", 0)), int(b.get("zfill", 0)), float(b.get("zp", 30.0))) for k, b in enumerate(bands)]
    return spark.createDataFrame(rows, "band_idx int, band string, name string, suffix string, delimiter string, fits_ext int, zfill int, zp double")


def by_tile(avail: DataFrame, order: list[str]) -> DataFrame:
    """xxx, yyy, bands (letters in the order given) and n_bands of each tile."""
    have = F.collect_set("band")
    letters = F.filter(F.array(*(F.lit(b) for b in order)), lambda b: F.array_contains("have", b))
    return avail.groupBy(*TILE).agg(have.alias("have")).select(*TILE, letters.alias("_b")).select(*TILE, F.array_join("_b", "").alias("bands"), F.size("_b").alias("n_bands"), F.col("_b").alias("band_list"))


def presence(avail: DataFrame, order: list[str]) -> DataFrame:
    """The 0/1 matrix of tiles and bands."""
    return avail.groupBy(*TILE).agg(*(F.max((F.col("band") == b).cast("int")).alias(f"in_{b}") for b in order))


def per_band(avail: DataFrame) -> DataFrame:
    return avail.distinct().groupBy("band").agg(F.count(F.lit(1)).alias("n_tiles"))


def band_counts(avail: DataFrame) -> DataFrame:
    """n_bands, the number of tiles with exactly as many and with at least as many bands, for numbers that occur."""
    counts = avail.groupBy(*TILE).agg(F.count_distinct("band").alias("n_bands")).groupBy("n_bands").agg(F.count(F.lit(1)).alias("n_tiles"))
    # A row for each number of bands: one task is right for this window.
    return counts.withColumn("at_least", F.sum("n_tiles").over(Window.orderBy(F.desc("n_bands")).rowsBetween(Window.unboundedPreceding, 0)))


def in_combinations(avail: DataFrame, order: list[str], band: str | None = None) -> DataFrame:
    """For each combination of bands (with `band` in it): tiles that have all of them. Tiles are counted by their set of bands first, at most 2^n rows."""
    spark = avail.sparkSession
    sets = by_tile(avail, order).groupBy("band_list").agg(F.count(F.lit(1)).alias("n"))
    combos = [("".join(c), list(c)) for k in range(1, len(order) + 1) for c in combinations(order, k) if band is None or band in c]
    wanted = spark.createDataFrame(combos, "combination string, wanted array<string>")
    met = F.broadcast(wanted).join(sets, F.size(F.array_except("wanted", "band_list")) == 0, "left")  # 2^n rows of a fixed registry on each side
    return met.groupBy("combination").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_tiles"))


def with_least(avail: DataFrame, order: list[str], least: int) -> DataFrame:
    return by_tile(avail, order).where(F.col("n_bands") >= least).drop("band_list")


def tiles_of(avail: DataFrame, band: str) -> DataFrame:
    return avail.where(F.col("band") == band).select(*TILE).distinct()


def look_up(tiles: DataFrame, avail: DataFrame, order: list[str]) -> DataFrame:
    """tiles with bands and n_bands; '' and 0 for tiles that no band has or that are null."""
    return tiles.join(by_tile(avail, order).drop("band_list"), TILE, "left").withColumns({"bands": F.coalesce("bands", F.lit("")), "n_bands": F.coalesce("n_bands", F.lit(0))})


def survey_tiles(listed: DataFrame, avail: DataFrame, order: list[str], least: int) -> DataFrame:
    """Listed tiles that enough bands have."""
    return listed.join(with_least(avail, order, least), TILE, "left_semi")


def report(objects: DataFrame, n_most: int) -> DataFrame:
    """One row: objects, those on a tile, and those in exactly and at least k bands. objects: tile, n_bands."""
    exact = [F.count_if(F.col("n_bands") == k).alias(f"in_{k}") for k in range(n_most + 1)]
    return objects.agg(F.count(F.lit(1)).alias("n_objects"), F.count("tile").alias("n_tiled"), *exact)
