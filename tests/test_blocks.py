"""Anomalies and background of images in blocks against the helpers that see the whole image."""

from __future__ import annotations

import numpy as np
import pytest

from astroloom.functions import transforms
from astroloom.operators import blocks

SHAPE, BLOCK = (45, 37), 16


def picture(seed: int = 3) -> np.ndarray:
    """Noise with flat patches: one across all nine blocks, one across a border, a thin one through a corner, small ones, and missing pixels."""
    rng = np.random.default_rng(seed)
    image = rng.normal(0, 1, SHAPE).astype(np.float32)
    image[2:40, 14:18] = 0.5
    image[14:18, 2:36] = 0.5
    image[30:36, 0:12] = 0.25
    image[22:24, 26:32] = 1
    image[44:, 20:] = 2
    image[5, 5], image[20, 20], image[40, 3] = np.nan, np.inf, 50
    return image


def cut(spark, images: dict[int, np.ndarray], gone: tuple = ()):
    rows = []
    for k, image in images.items():
        for y in range(0, image.shape[0], BLOCK):
            for x in range(0, image.shape[1], BLOCK):
                own = image[y : y + BLOCK, x : x + BLOCK]
                if (y // BLOCK, x // BLOCK) not in gone:
                    rows.append((k, y // BLOCK, x // BLOCK, *own.shape, own.ravel().tolist()))
    return spark.createDataFrame(rows, "tile int, by int, bx int, h int, w int, pix array<float>")


def whole(rows, column: str, shape=SHAPE) -> np.ndarray:
    out = np.zeros(shape, object)
    for r in rows:
        out[r["by"] * BLOCK : r["by"] * BLOCK + r["h"], r["bx"] * BLOCK : r["bx"] * BLOCK + r["w"]] = np.array(r[column]).reshape(r["h"], r["w"])
    return out


@pytest.fixture(scope="module")
def two(spark):
    return cut(spark, {1: picture(), 2: picture(8)[::-1]}).repartition(5).cache()


@pytest.mark.parametrize("least", [1, 12])
def test_patches_are_those_of_the_whole_image(two, least):
    got = {tuple(r) for r in blocks.flat_patches(two, ["tile"], 0.05, least, BLOCK).collect()}
    want = set()
    for k, image in ((1, picture()), (2, picture(8)[::-1])):
        _, across, down, diagonal = transforms.haar(image)
        for kind, detail in zip(blocks.KINDS, (diagonal, across, down), strict=True):
            label = transforms.components(np.abs(detail) <= 0.05)
            names, first, size = np.unique(label.ravel(), return_index=True, return_counts=True)
            want |= {(k, kind, *divmod(int(f), label.shape[1]), int(n)) for i, f, n in zip(names, first, size, strict=True) if i and n >= least}
    assert got == want and any(size > 60 for *_, size in want)


@pytest.mark.parametrize("dilate", [0, 1, 3])
def test_masks_and_flags(two, dilate):
    rows = blocks.flat_masks(two, ["tile"], 0.05, 12, dilate, BLOCK).where("tile = 1").collect()
    flags, mask = transforms.haar_anomaly(picture(), 0.05, 12, dilate)
    assert (whole(rows, "mask") == mask).all() and mask.any() and not mask.all()
    got = blocks.haar_anomalies(two, ["tile"], 0.05, 12, BLOCK).where("tile = 1").first()
    assert [got[k] for k in blocks.KINDS] == flags


def test_masks_grow_into_the_block_at_a_corner(spark):
    image = np.random.default_rng(0).normal(0, 1, (32, 32)).astype(np.float32)
    image[8:16, 8:16] = 0
    rows = blocks.flat_masks(cut(spark, {1: image}), ["tile"], 0.001, 4, 4, BLOCK).collect()
    assert (whole(rows, "mask", (32, 32)) == transforms.haar_anomaly(image, 0.001, 4, 4)[1]).all()


def test_background(two):
    image = picture()
    got = blocks.background_rms(two, ["tile"], 8, block=BLOCK).where("tile = 1").first()
    assert got["rms"] == pytest.approx(transforms.background_rms(image, 8), rel=1e-12)
    from pyspark.sql import functions as F

    rows = blocks.background_removed(two, ["tile"], F.lit(5), 8, -1e9, block=BLOCK).where("tile = 1").collect()
    level, _ = transforms.background(image, 8)
    some = np.isfinite(image)
    assert np.allclose(whole(rows, "pix").astype(float)[some], (image - level)[some], atol=1e-9)
    kept = blocks.replaced(two, ["tile"], F.col("tile"), 0.05, 12, 1, 8, BLOCK).where("tile = 1").collect()
    mask = transforms.haar_anomaly(image, 0.05, 12, 1)[1]
    made = whole(kept, "pix").astype(float)
    assert np.array_equal(made[~mask], image[~mask].astype(float), equal_nan=True) and np.abs(made[mask]).max() < 8 and made[mask].std() > 0.3


def test_spline_passes_through_the_squares_and_keeps_constants():
    level = np.random.default_rng(1).normal(0, 1, (5, 7))
    at = lambda n: np.arange(n) * 9 + 4
    assert np.allclose(transforms.spline(level, 9, at(5), at(7)), level)
    assert np.allclose(transforms.spline(np.full((3, 1), 2.5), 4, np.arange(12), np.arange(3)), 2.5)


def test_absent_blocks_and_odd_tables(spark):
    image = picture()
    some = cut(spark, {1: image}, gone=((1, 1),))
    hollow = image.copy()
    hollow[16:32, 16:32] = np.nan
    rows = blocks.flat_masks(some, ["tile"], 0.05, 12, 2, BLOCK).collect()
    want = transforms.haar_anomaly(hollow, 0.05, 12, 2)[1]
    want[16:32, 16:32] = False
    assert len(rows) == 8 and (whole(rows, "mask").astype(bool) == want).all()
    null = spark.createDataFrame([(1, 0, 0, 4, 4, None), (1, 0, 1, 0, 0, [])], some.schema)
    for empty in (some.limit(0), null):
        assert blocks.flat_patches(empty, ["tile"], block=BLOCK).count() == 0
        assert blocks.mesh_squares(empty, ["tile"], 8, block=BLOCK).count() == 0
    for bad in (lambda: blocks.flat_patches(some, ["tile"], block=15), lambda: blocks.mesh_squares(some, ["tile"], 10, block=BLOCK)):
        with pytest.raises(ValueError):
            bad()
