"""Anomalies, background and colour against plain loops."""

import numpy as np
import pytest

from astroloom.functions import transforms
from astroloom.operators import anomalies


def flood(mask):
    """Components by a stack, the plain way."""
    out, n = np.zeros(mask.shape, int), 0
    for i, j in np.ndindex(mask.shape):
        if mask[i, j] and not out[i, j]:
            n += 1
            todo = [(i, j)]
            while todo:
                y, x = todo.pop()
                if 0 <= y < mask.shape[0] and 0 <= x < mask.shape[1] and mask[y, x] and not out[y, x]:
                    out[y, x] = n
                    todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return out


@pytest.mark.parametrize("seed", range(5))
def test_components_equal_flooding(seed):
    mask = np.random.default_rng(seed).random((17, 23)) < 0.55
    np.testing.assert_array_equal(transforms.components(mask), flood(mask))


def test_haar_of_a_square():
    a, h, v, d = transforms.haar(np.array([[1.0, 2], [3, 5]]))
    assert (a[0, 0], h[0, 0], v[0, 0], d[0, 0]) == (5.5, -2.5, -1.5, 0.5)


def test_flat_patch_is_found_and_odd_sides_are_kept(spark):
    r = np.random.default_rng(1)
    clean = r.normal(0, 1, (41, 33)).astype(np.float32)
    flat = clean.copy()
    flat[4:24, 6:26] = 0
    rows = [(1, 41, 33, clean.ravel().tolist()), (2, 41, 33, flat.ravel().tolist()), (3, None, None, None)]
    df = spark.createDataFrame(rows, "id int, ny int, nx int, pix array<float>")
    got = {x.id: x for x in anomalies.haar_anomalies(df, ["id"], least=50).collect()}
    assert (got[1].diagonal, got[1].horizontal, got[1].vertical) == (False, False, False)
    assert (got[2].diagonal, got[2].horizontal, got[2].vertical) == (True, True, True)
    mask = np.array(got[2].mask).reshape(41, 33)
    assert mask[4:24, 6:26].all()
    assert mask.sum() < 20 * 20 + 60
    assert got[3].mask is None
    assert {x.id: x.found for x in anomalies.haar_levels(df, ["id"]).collect()}[2][0] == [True, True, True]
    once, again = ({x.id: x.pix for x in anomalies.replaced(df, ["id"], "id").collect()} for _ in range(2))
    assert once == again
    assert np.std(np.array(once[2]).reshape(41, 33)[6:22, 8:24]) > 0.5


def test_fourier_cross():
    r = np.random.default_rng(2)
    noise = r.normal(0, 1, (200, 200))
    striped = noise.copy()
    striped[100, :] += 80
    striped[:, 100] += 80
    for smooth in (False, True):
        assert not transforms.fourier_anomaly(noise, smooth=smooth)[3]
        assert not transforms.fourier_anomaly(noise + 5, smooth=smooth)[3]  # the zero frequency counts nowhere
        assert transforms.fourier_anomaly(striped, smooth=smooth)[3]
    m = np.abs(np.fft.fftshift(np.fft.fft2(striped)))
    vertical, horizontal, corners, _ = transforms.fourier_anomaly(striped)
    assert vertical == pytest.approx((m[:80, 99:102].sum() + m[120:, 99:102].sum()) / (2 * 80 * 3))
    assert horizontal == pytest.approx((m[99:102, :80].sum() + m[99:102, 120:].sum()) / (2 * 80 * 3))
    assert corners == pytest.approx(np.mean([m[:80, :80], m[:80, 120:], m[120:, :80], m[120:, 120:]]))


def test_smoothing_keeps_the_sum_inside():
    m = np.zeros((21, 21))
    m[10, 10] = 1
    out = transforms.smoothed(m)
    assert out.sum() == pytest.approx(1)
    assert out[10, 11] / out[10, 10] == pytest.approx(np.exp(-0.5))


def test_background_leaves_a_star_out():
    r = np.random.default_rng(3)
    image = r.normal(5, 2, (256, 256))
    image[10:14, 10:14] += 5000
    assert transforms.background_rms(image) == pytest.approx(2, rel=0.05)
    assert np.isnan(transforms.background_rms(np.full((8, 8), np.nan)))


def test_colours(spark):
    pix = np.arange(48, dtype=np.float32)
    df = spark.createDataFrame([(1, 12, 4, pix.tolist())], "id int, ny int, nx int, pix array<float>")
    rgb = np.frombuffer(anomalies.composites(df, ["id"]).first().rgb, np.uint8).reshape(4, 4, 3)
    light = pix.reshape(3, 16).astype(float).mean(axis=0)
    want = []
    for x in pix.reshape(3, 16).astype(float):  # scale, gamma, norm
        x = np.clip((x / np.percentile(light, 99.8) * 255) ** 0.35, 0, 255)
        want.append(np.clip(x / np.percentile(x, 99.8) * 255, 0, 255).astype(np.uint8))
    np.testing.assert_array_equal(rgb.reshape(16, 3).T, want)
    plain = transforms.composite(pix.reshape(3, 4, 4), gamma=None, norm=False)
    np.testing.assert_allclose(plain.reshape(3, 16), pix.reshape(3, 16) / np.percentile(light, 99.8) * 255)
    half = transforms.composite(pix.reshape(3, 4, 4), gains=(0.5, 1, 1))
    assert half[0].max() == 127 and half[1].max() == 255
    with pytest.raises(ValueError, match="unknown"):
        transforms.composite(np.zeros((3, 2, 2)), "other")


def test_desaturation_fills_from_the_rim():
    image = np.ones((21, 21), np.float32)
    image[9:12, 9:12] = 1000
    out = transforms.desaturated(image, 99)
    np.testing.assert_allclose(out, 1)


def test_low_patches_are_replaced_too():
    image = np.full((31, 31), 5.0)
    image[0, 0] = 9
    image[20:26, 20:26] = -3  # 36 low pixels
    image[3, 3] = -3  # too few
    out = transforms.desaturated(image, 100, grow=0, holes=False, negatives=True)
    assert (out[20:26, 20:26] == 5).all() and out[3, 3] == -3 and out[0, 0] == 5
    assert transforms.percentile_for(np.arange(101.0), 50) == pytest.approx(50)
    assert transforms.percentile_for(np.arange(101.0), -1) == 100
    assert transforms.percentile_for(np.array([0.0, 5, 5, 5]), 0) == 100  # only the minimum, which is percentile 0


def test_bright_channels_are_desaturated_before_display():
    r = np.random.default_rng(4)
    c = r.uniform(1, 100, (3, 40, 40))
    plain = transforms.chosen_colours(c)
    np.testing.assert_array_equal(plain, transforms.composite(c, stretch=0.9, q=5)[:, ::-1])
    c[:, 10:14, 10:14] = 60000
    out = transforms.chosen_colours(c)
    assert out.shape == (3, 40, 40) and np.median(out) > 2 * np.median(transforms.composite(c)[:, ::-1])
