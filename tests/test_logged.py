"""Appends with a log: repeats, two writers, ranges that overlap, writers that die."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from astroloom.sinks import logged


def rows(spark, low: int, high: int, tag: str):
    return spark.range(low, high).select("id", F.lit(tag).alias("tag"))


def test_two_writers_and_a_repeat_give_each_key_once(spark, tmp_path):
    path = str(tmp_path / "t")
    logged.start(spark, path, "id long, tag string", "id", 1 << 20)
    assert logged.read(spark, path).count() == 0
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda a: logged.append(rows(spark, *a[:3]), path, a[3]), [(0, 100, "a", "one"), (50, 150, "b", "two"), (0, 100, "a", "one"), (300, 400, "c", "three")]))
    assert made.count(True) == 3 and made[3]
    assert not logged.append(rows(spark, 0, 100, "again"), path, "two")
    got = {r["id"]: r["tag"] for r in logged.read(spark, path).collect()}
    assert logged.read(spark, path).count() == len(got) == 250 and "again" not in got.values()
    first = [x["batch"] for x in logged.log(spark, path) if x["batch"] != "three"][0]
    assert {got[k] for k in range(50, 100)} == {"a" if first == "one" else "b"}
    assert sorted(x["number"] for x in logged.log(spark, path)) == [0, 1, 2]


def test_nulls_repeats_within_a_batch_and_dead_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="table.json"):
        logged.read(spark, path)
    logged.start(spark, path, "id long, tag string", "id")
    with pytest.raises(ValueError):
        logged.start(spark, path, "id long", "id")
    null = spark.createDataFrame([(None, "x"), (None, "x"), (5, "x")], "id long, tag string")
    assert logged.append(null, path, "n1") and logged.append(null.where("id is null"), path, "n2") and logged.append(null.limit(0), path, "empty")
    rows(spark, 0, 9, "dead").write.parquet(f"{path}/data/dead")
    assert sorted(map(tuple, logged.read(spark, path).collect()), key=str) == [(5, "x"), (None, "x")]


def test_batches_apart_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    logged.start(spark, path, "id long, tag string", "id")
    for k in range(3):
        logged.append(rows(spark, 10 * k, 10 * k + 10, "x"), path, f"b{k}")
    plan = logged.read(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
