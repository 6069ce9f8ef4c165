"""Labels from other catalogues on detections."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crossmatch import nearest

GALAXY = 2.0
#: Radii of the matches in arc seconds: redshifts and lenses, dwarfs.
NEAR, FAR = 1.0, 10.0


def range_of(det: DataFrame) -> tuple | None:
    """Least and greatest ra and dec of the detections, from one scan of two columns; None without detections."""
    found = det.agg(F.min("ra"), F.max("ra"), F.min("dec"), F.max("dec")).first()
    return None if found[0] is None or found[2] is None else tuple(found)


def within(labels: DataFrame, box: tuple | None, margin: float = 10 / 3600) -> DataFrame:
    """Labels within a range_of() and a margin in degrees; the scan of the labels gets the filters. A range across ra 0 isn't narrowed in ra."""
    if box is None:
        return labels.where(F.lit(False))
    low_ra, high_ra, low, high = box
    near = labels.where(F.col("dec").between(low - margin, high + margin))
    widest = margin / max(math.cos(math.radians(min(max(abs(low), abs(high)) + margin, 89.9))), 1e-3)
    if low_ra - widest < 0 or high_ra + widest > 360:
        return near
    return near.where(F.col("ra").between(low_ra - widest, high_ra + widest))


def in_range_of(labels: DataFrame, det: DataFrame, margin: float = 10 / 3600) -> DataFrame:
    """Labels within the range of the detections; without detections none."""
    return within(labels, range_of(det), margin)


def attach(det: DataFrame, z: DataFrame, lens: DataFrame, dwarf: DataFrame) -> DataFrame:
    """Detections with class_label, zspec, lens and lsb, and the dwarfs that no detection matches.

    det: det_id (unique), ra, dec, tile and more; z, lens and dwarf: label_id (position in their catalogue), ra, dec, and cspec and zspec or tile.
    Each tile finds its own nearest detection. Of several redshifts on a detection the last one holds, nulls included.
    Dwarfs match within their tile and make their detection a galaxy. Without labels nothing matches.
    All three are matched in one pass, each within its own radius, and what is found is joined to the detections once. Scans of redshifts and lenses read what lies in the range of the
    detections; dwarfs are added whether or not they match, so all of them are read."""
    box = range_of(det)
    z, lens = within(z, box), within(lens, box)
    none = F.lit(None).cast("double")
    kinds = ((z, 0, NEAR, F.col("cspec"), F.col("zspec"), F.lit(None)), (lens, 1, NEAR, none, none, F.lit(None)), (dwarf, 2, FAR, none, none, F.col("tile")))
    sought = None
    for table, k, reach, cspec, zspec, home in kinds:
        lab = F.struct(F.lit(k).alias("kind"), "label_id", cspec.cast("double").alias("cspec"), zspec.cast("double").alias("zspec"), home.cast("string").alias("home"))
        rows = table.select("ra", "dec", F.lit(reach).alias("reach"), lab.alias("lab"))
        sought = rows if sought is None else sought.unionByName(rows)
    met = nearest(sought, det, FAR, "lab", each=["tile"], reach="reach").select("det_id", "tile", "reach", "lab.*")
    hits = met.where((F.col("reach") < FAR) | (F.col("home") == F.col("tile").cast("string")))
    kind = F.col("kind")
    found = hits.groupBy("det_id").agg(
        F.max_by(F.struct("cspec", "zspec"), F.when(kind == 0, F.col("label_id"))).alias("v"),
        F.max(F.when(kind == 1, F.lit(1.0))).alias("lens"),
        F.max(F.when(kind == 2, F.lit(1.0))).alias("lsb"),
    )
    out = det.join(found, "det_id", "left")
    out = out.withColumns({"class_label": F.when(F.col("lsb") == 1, F.lit(GALAXY)).otherwise(F.col("v.cspec")), "zspec": F.col("v.zspec")}).select(*det.columns, "class_label", "zspec", "lens", "lsb")
    # Conditions that can't be pushed below the match, so that its shuffled result serves both uses.
    known = met.where(F.col("reach") == FAR).select(F.col("label_id").alias("_known"), F.col("tile").cast("string").alias("_tile"))
    own = F.col("tile").cast("string")
    rest = dwarf.join(known, F.col("label_id").eqNullSafe(F.col("_known")) & own.eqNullSafe(F.col("_tile")) & own.isNotNull(), "left_anti")
    common = [c for c in dwarf.columns if c in det.columns]
    added = rest.select(*common).withColumns({"class_label": F.lit(GALAXY), "lsb": F.lit(1.0)})
    return out.unionByName(added, allowMissingColumns=True)


def refresh(stored: DataFrame, fresh: DataFrame, columns: list[str]) -> DataFrame:
    """Stored rows with newer labels, matched by ra and dec as 32-bit floats; rows that have no match keep what they had. changed counts nulls as equal."""
    # Left-join on the exact stored precision; of several fresh rows for a position the greatest is taken.
    new = fresh.select(F.col("ra").cast("float").alias("ra"), F.col("dec").cast("float").alias("dec"), F.struct(*(F.col(c).cast("float").alias(c) for c in columns)).alias("new")).groupBy("ra", "dec").agg(F.max("new").alias("new"))
    old = stored.withColumns({"ra": F.col("ra").cast("float"), "dec": F.col("dec").cast("float")})
    both = old.join(new, ["ra", "dec"], "left")
    has = F.col("new").isNotNull()
    values = {c: F.when(has, F.col(f"new.{c}")).otherwise(F.col(c).cast("float")) for c in columns}
    same = [F.col(f"new.{c}").eqNullSafe(F.col(c).cast("float")) for c in columns]
    changed = has & ~F.forall(F.array(*same), lambda x: x)
    return both.withColumn("changed", changed).withColumns(values).drop("new")


def counts(labelled: DataFrame) -> DataFrame:
    return labelled.agg(*(F.count(c).alias(f"n_{c}") for c in ("class_label", "zspec", "lens", "lsb")))
