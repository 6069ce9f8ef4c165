"""Nearest neighbours on the sky within a radius.

Positions become unit vectors, by the C library's functions. Detections go to the one cell that they are in,
labels to all cells that their own radius touches, and both meet in an
equi-join. Cells are several radii wide, so a label touches two or three of
them on average and eight at most. Cells in three dimensions know no seam at ra 0
and no pole."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sky

#: Width of a cell in radii, 2 at least, so that a label touches two cells of an axis at most; wider ones mean fewer copies of a label and more detections to compare it with.
WIDTH = 4


def _chord(arcsec: float | Column) -> Column:
    return 2 * F.sin(F.radians((F.lit(arcsec) if isinstance(arcsec, (int, float)) else arcsec) / 3600) / 2)


def nearest(labels: DataFrame, detections: DataFrame, max_sep: float, label: str = "label_id", detection: str = "det_id", same: list[str] | None = None, each: list[str] | None = None, reach: str | None = None) -> DataFrame:
    """label, detection and sep (arc seconds, under max_sep) for each label that has a detection near; of equal ones the least detection.

    same: columns that both sides share and that must be equal. each: columns of the detections for whose every value a nearest one is sought.
    reach: a column of the labels with a radius of their own, max_sep at most, so that labels of several kinds meet the detections in one join; it is kept."""
    same, each = same or [], each or []
    w = WIDTH * 2 * math.sin(math.radians(max_sep / 3600) / 2)
    own = F.col(reach) if reach else F.lit(float(max_sep))
    axes = range(3)
    vector = sky.unit_vector_c(F.col("ra"), F.col("dec"))
    parts = lambda name: [F.col(f"v.{c}").alias(f"{name}{k}") for k, c in enumerate("xyz")]
    left = labels.select(label, *same, own.alias("reach"), (_chord(own) * (1 + 1e-9)).alias("h"), vector.alias("v")).select(label, *same, "reach", "h", *parts("l"))
    for k in axes:
        x = F.col(f"l{k}")
        left = left.withColumn(f"c{k}", F.explode(F.array_distinct(F.array(F.floor((x - F.col("h")) / w), F.floor((x + F.col("h")) / w)))))
    left = left.drop("h")
    right = detections.select(detection, *same, *each, vector.alias("v")).select(detection, *same, *each, *parts("d"))
    right = right.select("*", *(F.floor(F.col(f"d{k}") / w).alias(f"c{k}") for k in axes))
    away = sky.chord(tuple(F.col(f"l{k}") for k in axes), tuple(F.col(f"d{k}") for k in axes))
    met = left.join(right, ["c0", "c1", "c2", *same]).select(label, *each, "reach", F.col(detection).alias("det"), away.alias("away"))
    # Pairs beyond the radius (a little wider, as the angle decides) don't reach the aggregation.
    met = met.where(F.col("away") <= _chord(F.col("reach")) * (1 + 1e-6))
    best = met.groupBy(label, *each).agg(F.min(F.struct("away", "det")).alias("m"), F.first("reach").alias("reach"))
    out = best.select(label, *each, F.col("m.det").alias(detection), sky.separation(F.col("m.away")).alias("sep"), F.col("reach").alias(reach or "reach")).where(F.col("sep") < F.col(reach or "reach"))
    return out if reach else out.drop("reach")


def unmatched(labels: DataFrame, matches: DataFrame, label: str = "label_id") -> DataFrame:
    return labels.join(matches, label, "left_anti")


def union_catalogs(a: DataFrame, b: DataFrame, max_sep: float = 15.0, a_key: str = "label_id", b_key: str = "det_id") -> DataFrame:
    """All of the longer catalogue and the rows of the shorter one that it lacks; the first counts as shorter when both are alike. Both have ra, dec and a key of their own; one pass counts each."""
    first = a.count() <= b.count()
    (short, s), (long, d) = ((a, a_key), (b, b_key)) if first else ((b, b_key), (a, a_key))
    found = nearest(short.withColumn("_s", F.col(s)), long.withColumn("_d", F.col(d)), max_sep, "_s", "_d")
    return short.join(found.select(F.col("_s").alias(s)), s, "left_anti").unionByName(long, allowMissingColumns=True)
