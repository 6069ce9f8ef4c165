"""Spectra of images in blocks against the transform of the whole image."""

from __future__ import annotations

import numpy as np
import pytest

from astroloom.functions import transforms
from astroloom.operators import fourier
from test_blocks import BLOCK, SHAPE, cut, picture


def striped(shape=SHAPE) -> np.ndarray:
    """Noise under lines along both axes, which show as arms."""
    image = np.random.default_rng(4).normal(0, 1, shape).astype(np.float32)
    image[::7] += 40
    image[:, ::5] += 40
    return image


def clean(image: np.ndarray) -> np.ndarray:
    return np.nan_to_num(image.astype(float), nan=0.0, posinf=0.0, neginf=0.0)


def together(rows, shape) -> np.ndarray:
    out = np.full(shape, np.nan)
    for r in rows:
        assert np.isnan(out[r.y : r.y + r.h, r.x : r.x + r.w]).all()  # each place once
        out[r.y : r.y + r.h, r.x : r.x + r.w] = np.array(r.pix).reshape(r.h, r.w)
    return out


@pytest.mark.parametrize("shape", [SHAPE, (48, 32), (16, 33), (5, 1), (1, 6), (33, 2)])
@pytest.mark.parametrize(("smooth", "columns"), [(False, 1), (False, 256), (True, 4), (True, 7), (True, 256)])
def test_spectra_are_those_of_the_whole_image(spark, shape, smooth, columns):
    image = striped(shape)
    got = together(fourier.spectra(cut(spark, {1: image}), ["tile"], smooth, False, columns, BLOCK).collect(), shape)
    np.testing.assert_allclose(got, transforms.spectrum(image.astype(float), smooth), rtol=1e-9, atol=1e-8)


@pytest.mark.parametrize(("smooth", "arms"), [(False, None), (True, (2, 12, 9)), (False, (1, 10, 12))])
def test_anomalies_are_those_of_whole_images(spark, smooth, arms):
    images = {1: picture(), 2: striped(), 3: picture(9)[::-1]}
    got = {r.tile: tuple(r)[1:] for r in fourier.anomalies(cut(spark, images), ["tile"], 3.0, smooth, arms, 5, BLOCK).collect()}
    want = {k: transforms.fourier_anomaly(clean(image), 3.0, smooth, arms) for k, image in images.items()}
    assert got.keys() == want.keys()
    for k in want:
        np.testing.assert_allclose(got[k][:3], want[k][:3], rtol=1e-9)
        assert got[k][3] == want[k][3]
    assert not want[1][3] and (arms is None or want[2][3])


def test_absent_blocks_count_as_zero_and_empty_ones_as_absent(spark):
    image = striped()
    blocks = cut(spark, {1: image}, gone=((1, 0), (1, 1), (1, 2), (0, 1)))
    more = spark.createDataFrame([(1, 0, 1, 16, 16, None), (2, 0, 0, 0, 0, []), (3, 0, 0, 1, 1, [float("nan")])], blocks.schema)
    image[16:32], image[:16, 16:32] = 0, 0
    rows = fourier.spectra(blocks.unionByName(more), ["tile"], log=True, block=BLOCK).collect()
    np.testing.assert_allclose(together([r for r in rows if r.tile == 1], SHAPE), transforms.spectrum(image.astype(float), log=True), rtol=1e-9, atol=1e-9)
    assert [list(r.pix) for r in rows if r.tile != 1] == [[0.0]] and {r.tile for r in rows} == {1, 3}
    assert fourier.anomalies(blocks.limit(0), ["tile"]).count() == 0
    with pytest.raises(ValueError, match="narrower"):
        fourier.spectra(blocks, ["tile"], smooth=True, columns=3)
