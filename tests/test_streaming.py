"""Streams over files against the same work in one batch."""

from pyspark.sql import functions as F

from astroloom.streaming import tiles

SCHEMA = "tile int, at timestamp_ntz, v double"


def table(spark):
    return spark.range(90).select((F.col("id") % 5).cast("int").alias("tile"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id)").alias("at"), F.col("id").cast("double").alias("v"))


def by_tile(df):
    return df.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    table(spark).repartition(6).write.parquet(folder)
    run = lambda: tiles.delivered(tiles.arriving(spark, folder, SCHEMA), by_tile, out, check).awaitTermination()
    run()
    total = lambda: sorted(tuple(r) for r in spark.read.parquet(out).groupBy("tile").agg(F.sum("n"), F.sum("s")).collect())
    assert total() == sorted(tuple(r) for r in by_tile(table(spark)).collect())
    batches = spark.read.parquet(out).select("batch").distinct().count()
    assert batches == 3
    run()
    assert spark.read.parquet(out).select("batch").distinct().count() == batches
    table(spark).where("tile = 1").coalesce(1).write.mode("append").parquet(folder)
    run()
    assert dict((t, n) for t, n, _ in total()) == {0: 18, 1: 36, 2: 18, 3: 18, 4: 18}


def test_windows_of_event_time(spark, tmp_path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    table(spark).coalesce(1).write.parquet(folder)
    days = tiles.windowed(tiles.arriving(spark, folder, SCHEMA), "at", "1 day", "0 seconds", ["tile"], n=F.count(F.lit(1)))
    days.writeStream.format("memory").queryName("days").outputMode("complete").option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("days").count() == 20
    assert spark.table("days").agg(F.sum("n")).first()[0] == 90
