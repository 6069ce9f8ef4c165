"""Cutouts from image tiles that are stored as blocks.

An image is rows (image, by, bx, h, w, pix): blocks of BLOCK x BLOCK pixels, so
that no row holds a whole tile. A cutout joins its object with the few blocks
under it, slices their rows and puts the slices together by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pixels import any_set

BLOCK = 512


def to_blocks(images: DataFrame, image: list[str], block: int = BLOCK) -> DataFrame:
    """Blocks of images that are given whole: image columns, ny, nx and pix (row by row)."""
    at = lambda n: F.sequence(F.lit(0), F.floor((F.col(n) - 1) / block).cast("int"))
    cut = images.select(*image, "ny", "nx", "pix", F.explode(at("ny")).alias("by")).select("*", F.explode(at("nx")).alias("bx"))
    h, w = F.least(F.lit(block), F.col("ny") - F.col("by") * block), F.least(F.lit(block), F.col("nx") - F.col("bx") * block)
    rows = F.flatten(F.transform(F.sequence(F.lit(0), h - 1), lambda r: F.slice("pix", (F.col("by") * block + r) * F.col("nx") + F.col("bx") * block + 1, w)))
    return cut.select(*image, "by", "bx", h.cast("int").alias("h"), w.cast("int").alias("w"), rows.alias("pix"))


def cutouts(objects: DataFrame, blocks: DataFrame, image: list[str], key: list[str], size: int, block: int = BLOCK, start: str = "round") -> DataFrame:
    """key, image columns, pix (size x size, zeros outside the image). An object that no pixel of the image lies under gives no row.

    objects: key, x, y and those image columns that both sides have. start: 'round' takes the pixel nearest to the centre less half the size; 'ceil' the first pixel at or after it."""
    if start not in ("round", "ceil"):
        raise ValueError(start)
    shared = [c for c in image if c in objects.columns]
    first = (lambda c: (F.floor(F.col(c) + 0.5) - size // 2).cast("int")) if start == "round" else (lambda c: F.ceil(F.col(c) - size / 2).cast("int"))
    o = objects.select(*dict.fromkeys([*key, *shared]), first("y").alias("y0"), first("x").alias("x0"))
    over = lambda c: F.sequence(F.greatest(F.lit(0), F.floor(F.col(c) / block).cast("int")), F.greatest(F.lit(0), F.floor((F.col(c) + size - 1) / block).cast("int")))
    o = o.select("*", F.explode(over("y0")).alias("by")).select("*", F.explode(over("x0")).alias("bx"))
    met = o.join(blocks, ["by", "bx", *shared])
    top, left = F.greatest(F.col("y0"), F.col("by") * block), F.greatest(F.col("x0"), F.col("bx") * block)
    bottom, right = F.least(F.col("y0") + size, F.col("by") * block + F.col("h")), F.least(F.col("x0") + size, F.col("bx") * block + F.col("w"))
    met = met.withColumns({"_t": top, "_l": left, "_b": bottom, "_r": right}).where("_b > _t and _r > _l")
    row = lambda y: F.struct(((y - F.col("y0")) * size + F.col("_l") - F.col("x0")).cast("int").alias("at"), F.slice("pix", ((y - F.col("by") * block) * F.col("w") + F.col("_l") - F.col("bx") * block + 1).cast("int"), (F.col("_r") - F.col("_l")).cast("int")).alias("v"))
    pieces = met.select(*dict.fromkeys([*key, *image]), F.transform(F.sequence(F.col("_t"), F.col("_b") - 1), row).alias("rows"))
    # A group is the blocks under one cutout.
    whole = pieces.groupBy(*dict.fromkeys([*key, *image])).agg(F.array_sort(F.flatten(F.collect_list("rows"))).alias("rows"))
    return whole.select(*dict.fromkeys([*key, *image]), _joined(F.col("rows"), size * size).alias("pix"))


def _joined(rows: Column, n: int) -> Column:
    """The slices in order, with zeros in the gaps."""
    zeros = lambda k: F.array_repeat(F.lit(0.0).cast("float"), k)
    end = lambda i: F.coalesce(F.get(rows, i - 1).at + F.size(F.get(rows, i - 1).v), F.lit(0))
    body = F.flatten(F.transform(rows, lambda r, i: F.concat(zeros(r["at"] - end(i)), r.v)))
    return F.concat(body, zeros(n - end(F.size(rows))))


def validated(pix: Column, size: int, most_missing: float = 0.05) -> Column:
    """All zeros where a share of `most_missing` or more is missing or nothing is set; else missing pixels become zero."""
    missing = F.size(F.filter(pix, F.isnan))
    clean = F.transform(pix, lambda v: F.when(F.isnan(v), F.lit(0.0).cast("float")).otherwise(v))
    return F.when((missing >= most_missing * size * size) | ~any_set(clean), F.array_repeat(F.lit(0.0).cast("float"), size * size)).otherwise(clean)


def stacks(cut: DataFrame, key: list[str], order: list[str], size: int, compact: bool = False) -> DataFrame:
    """key and images (an array for each band). Bands stand at their place in the registry and missing ones are zeros; compact leaves gaps out; of two images in a band the greater array counts. cut: key, band, pix."""
    by_band = cut.groupBy(*key).agg(F.array(*(F.max(F.when(F.col("band") == b, F.col("pix"))) for b in order)).alias("m"))
    listed = F.col("m")
    images = F.filter(listed, lambda p: p.isNotNull()) if compact else F.transform(listed, lambda p: F.coalesce(p, F.array_repeat(F.lit(0.0).cast("float"), size * size)))
    return by_band.select(*key, images.alias("images"))
