"""Tiles that arrive late, never, or at once, across a restart of the stream."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import functions as F

from astroloom.streaming import retries, tiles


def until(what, seconds: float = 60) -> bool:
    end = time.time() + seconds
    while time.time() < end:
        if what():
            return True
        time.sleep(0.3)
    return False


def test_late_tiles_are_made_and_absent_ones_fail_after_three_attempts(spark, tmp_path):
    data, folder, out, status, check, log = (tmp_path / x for x in ("data", "in", "out", "status", "check", "log"))
    data.mkdir()
    log.mkdir()
    (data / "1_1").write_text("x")
    spark.createDataFrame([(1, 1), (2, 2), (3, 3), (3, 3)], "xxx int, yyy int").coalesce(1).write.parquet(str(folder))
    here, seen = str(data), str(log)

    def ready(key):
        with open(f"{seen}/{key[0]}", "a") as f:
            f.write("x")
        if key[0] == 3:
            raise OSError("no such store")
        return Path(f"{here}/{key[0]}_{key[1]}").exists()

    tried = lambda x: len((log / str(x)).read_text()) if (log / str(x)).exists() else 0
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        start = lambda: retries.retried(tiles.arriving(spark, str(folder), "xxx int, yyy int"), ["xxx", "yyy"], ready, lambda t: t.withColumn("made", F.lit(True)), str(out), str(status), str(check), pause=8.0, every="200 milliseconds")
        q = start()
        assert until(lambda: all(tried(k) for k in (1, 2, 3)) and (check / "commits" / "0").exists())
        q.stop()
        assert tried(2) == tried(3) == 1
        (data / "2_2").write_text("x")
        q = start()
        ended = lambda: {(r["xxx"], r["status"], r["attempts"]) for r in spark.read.parquet(str(status)).collect()}
        assert until(lambda: len(ended()) == 3)
        q.stop()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert ended() == {(1, "ready", 1), (2, "ready", 2), (3, "failed", 3)}
    assert sorted(r["xxx"] for r in spark.read.parquet(str(out)).collect()) == [1, 2]
