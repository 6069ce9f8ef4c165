"""Compensated sums over many tasks and global row numbers."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from astroloom.operators import ranks, statistics


def test_sums_that_cancel_over_many_tasks(spark):
    rows = [(g, v) for g in (1, 2) for v in [1e16, 1.0, -1e16] * 50] + [(3, None), (None, 0.1), (None, 0.2), (4, math.inf), (4, 1.0), (5, math.nan), (6, 1e308), (6, 1e308), (6, -1e308)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(23)
    got = {r["g"]: r["v"] for r in statistics.compensated_sums(df, ["g"], ["v"]).collect()}
    assert (got[1], got[2], got[3], got[None], got[4]) == (50.0, 50.0, 0.0, math.fsum([0.1, 0.2]), math.inf) and math.isnan(got[5])
    whole = statistics.compensated_sums(df.where("g < 3"), [], ["v"]).collect()
    assert [r["v"] for r in whole] == [100.0]
    assert statistics.compensated_sums(df.limit(0), ["g"], ["v"]).count() == 0


def test_expansions_are_exact():
    rng = np.random.default_rng(1)
    v = (rng.normal(0, 1, 500) * 10.0 ** rng.integers(-30, 30, 500)).tolist()
    assert sum(map(Fraction, statistics.expansion(v))) == sum(map(Fraction, v)) and len(statistics.expansion(v)) < 12


def test_mean_and_std_of_far_numbers(spark):
    """Squares that agree in their first sixteen digits."""
    stats = spark.createDataFrame([(b, 4, 4e8 + k, 4e16 + 2e8 * k + k * k) for b in ("u", "z") for k in range(30)], "band string, n_valid_pixels long, sum_pixel_values double, sum_pixel_values_squared double").repartition(7)
    s, q, n = (sum(Fraction(x) for x in v) for v in ([4e8 + k for k in range(30)], [4e16 + 2e8 * k + k * k for k in range(30)], [4] * 30))
    want = math.sqrt((q - s * s / n) / n)
    for r in statistics.compensated_mean_std(stats, ["band"]).collect():
        assert (r["n"], r["mean"]) == (120, float(s / n)) and r["std"] == pytest.approx(want, rel=1e-9)
    assert statistics.compensated_mean_std(stats).first()["n"] == 240


def test_numbers_of_rows(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 < 4, 7).otherwise(F.col("id") % 90).alias("k"), "id", F.lit("x").alias("_n")).repartition(9)
    got = ranks.numbered(df, ["k", "id"]).collect()
    assert [r["number"] for r in sorted(got, key=lambda r: (r["k"], r["id"]))] == list(range(1000))
    sizes = [r["count"] for r in ranks.balanced_shards(df, ["k", "id"], 7).groupBy("rank").count().collect()]
    assert sorted(sizes) == [142, 143, 143, 143, 143, 143, 143]
    assert {r["batch"]: r["count"] for r in ranks.exact_batches(df, ["k", "id"], 300).groupBy("batch").count().collect()} == {0: 300, 1: 300, 2: 300, 3: 100}
    assert ranks.numbered(df.limit(0), ["k"]).count() == 0


def test_no_task_numbers_all_rows(spark):
    plan = ranks.numbered(spark.range(1000), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :].splitlines()
    assert "Aggregate" in " ".join(window[:3])  # the one window sees a row for each range
