"""Tiles as a stream: new files become statistics or cutouts, each once.

The checkpoint is the ledger of what was done, files per trigger bound what is in
flight, and available_now ends the stream when no work is left. A batch is written
under its number, so a batch that runs again replaces its own rows.

Defined results: a folder without files ends at once and writes nothing; a file
that is seen again is not read again; rows with null keys pass through."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import images, statistics


def arriving(spark: SparkSession, folder: str, schema: str | StructType, per_trigger: int = 2, fmt: str = "parquet", glob: str = "*", clean: str = "off", archive: str | None = None) -> DataFrame:
    """Rows of files as they arrive. clean: off, delete, or archive (into the folder archive)."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", glob).option("cleanSource", clean)
    return (reader.option("sourceArchiveDir", archive) if archive else reader).load(folder)


def delivered(stream: DataFrame, made: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write made(batch) of every batch to out, in a folder for each batch. Readers see the column batch."""

    def write(batch: DataFrame, number: int) -> None:
        made(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def running_totals(stream: DataFrame, keys: list[str], **totals: Column) -> DataFrame:
    """Aggregates over all that has arrived, for output mode complete or update."""
    return stream.groupBy(*keys).agg(*(c.alias(n) for n, c in totals.items()))


def windowed(stream: DataFrame, at: str, length: str, late: str, keys: list[str], **totals: Column) -> DataFrame:
    """Aggregates over windows of event time; rows later than `late` are left out. Time without a zone counts as the session's."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    got = timed.groupBy(F.window(at, length), *keys).agg(*(c.alias(n) for n, c in totals.items()))
    return got.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, *totals)


def cut(blocks: DataFrame, objects: DataFrame, image: list[str], key: list[str], size: int, order: list[str], block: int = images.BLOCK, labels: list[str] | None = None) -> Callable[[DataFrame], DataFrame]:
    """For delivered(): the stacks of the objects on the tiles of a batch, with their labels. batch: xxx, yyy; blocks: image columns with band, by, bx, h, w, pix; objects: key, xxx, yyy, x, y and labels."""

    def made(batch: DataFrame) -> DataFrame:
        own = objects.join(batch.select("xxx", "yyy").distinct(), ["xxx", "yyy"], "left_semi")
        one = images.cutouts(own, blocks, image, [*key, "xxx", "yyy"], size, block)
        stacked = images.stacks(one, [*key, "xxx", "yyy"], order, size)
        return stacked.join(own.select(*key, "ra", "dec", *(labels or [])), key)

    return made


def measured(blocks: DataFrame, key: list[str]) -> Callable[[DataFrame], DataFrame]:
    """For delivered(): the pixel statistics of the tiles of a batch. batch: xxx, yyy; blocks: key with xxx and yyy, and pix."""

    def made(batch: DataFrame) -> DataFrame:
        own = blocks.join(batch.select("xxx", "yyy").distinct(), ["xxx", "yyy"], "left_semi")
        return statistics.pixel_stats(statistics.explode_pixels(own, key), key)

    return made


def accounted(stream: DataFrame, made: Callable[[DataFrame], DataFrame], out: str, status: str, checkpoint: str, key: list[str], available_now: bool = True) -> StreamingQuery:
    """delivered(), and for each key of a batch whether anything was made of it: status made or failed. A batch that fails is tried again by Spark; a tile without data doesn't stop the others."""

    def write(batch: DataFrame, number: int) -> None:
        made(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")
        done = batch.sparkSession.read.parquet(f"{out}/batch={number}").select(*key).distinct().withColumn("status", F.lit("made"))
        every = batch.select(*key).distinct().join(done, key, "left").withColumn("status", F.coalesce("status", F.lit("failed")))
        every.write.mode("overwrite").parquet(f"{status}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def queue(manifest: DataFrame, status: DataFrame, key: list[str]) -> DataFrame:
    """manifest with the status of each tile: made, failed or waiting."""
    known = status.groupBy(*key).agg(F.max("status").alias("status"))  # made after failed
    return manifest.join(known, key, "left").withColumn("status", F.coalesce("status", F.lit("waiting")))
