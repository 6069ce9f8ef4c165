"""Percentiles of images whose pixels are spread over tasks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from astroloom.operators import statistics


@pytest.mark.parametrize("spread", [1, 16])
def test_a_large_image_is_shared_by_tasks(spark, spread):
    r = random.Random(spread)
    images = {"large": [r.choice([0.0, r.gauss(0, 1)]) for _ in range(20_000)], "flat": [2.5] * 300, "one": [7.0], "holes": [1.0, float("nan"), 4.0]}
    rows = [(k, n, v) for k, values in images.items() for n, v in enumerate(values)] + [("none", 0, None)]
    pixels = spark.createDataFrame(rows, "img string, place int, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = statistics.percentiles(pixels, ["img"], [0.0, 0.02, 0.5, 1.0], spread=spread)
        got = {x.img: x.p for x in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {k: np.percentile([x for x in v if x == x], [0, 2, 50, 100]) for k, v in images.items()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert any("hashpartitioning(img" in x and "_s" in x for x in plan.splitlines())


def test_salts_even_out(spark):
    """The hash of a pixel's columns deals an image evenly."""
    n = spark.range(16_000).select(F.pmod(F.xxhash64(F.lit("a"), "id", F.lit(0.0)), F.lit(16)).alias("s")).groupBy("s").count().agg(F.max("count"), F.min("count")).first()
    assert n[0] < 1.2 * 1000 and n[1] > 0.8 * 1000
