"""Labels that lie at the very radius of a match, where the last bit of a sine decides."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from astroloom.operators import crossmatch


def _vector(ra, dec):
    a, d = math.radians(ra), math.radians(dec)
    return math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)


def test_labels_at_the_radius_match_as_the_c_library_says(spark):
    spots = [(k, k * 7919 % 3600000 / 10000.0, k * 104729 % 1600000 / 10000.0 - 80) for k in range(1, 40000)]
    want = set()
    for k, ra, dec in spots:
        (a, b, c), (x, y, z) = _vector(ra, dec + 1.0 / 3600), _vector(ra, dec)
        away = math.sqrt((a - x) * (a - x) + (b - y) * (b - y) + (c - z) * (c - z))
        if math.degrees(2 * math.asin(away / 2)) * 3600 < 1.0:
            want.add(k)
    det = spark.createDataFrame(spots, "det_id long, ra double, dec double")
    lab = det.select(F.col("det_id").alias("label_id"), "ra", (F.col("dec") + F.lit(1.0) / 3600).alias("dec"))
    got = {r.label_id for r in crossmatch.nearest(lab, det, 1.0).where("label_id = det_id").collect()}
    assert got == want and 0 < len(want) < len(spots)


def test_rows_without_a_position_match_nothing(spark):
    det = spark.createDataFrame([(1, 10.0, 20.0), (2, None, 20.0), (3, 10.0, None)], "det_id long, ra double, dec double")
    assert [tuple(r) for r in crossmatch.nearest(det.withColumnRenamed("det_id", "label_id"), det, 1.0).select("label_id", "det_id").collect()] == [(1, 1)]
