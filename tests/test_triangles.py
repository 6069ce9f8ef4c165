"""Interpolation over Delaunay triangles against a search of all triangles."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from astroloom.functions import transforms


def brute(points: np.ndarray, values: np.ndarray, place: np.ndarray) -> list[float]:
    """The values at a place over every triangle that holds it and whose circle holds no point inside; several if points share a circle."""
    out = []
    p = points.tolist()
    for three in combinations(range(len(p)), 3):
        (ax, ay), (bx, by), (cx, cy) = (p[k] for k in three)
        area = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
        if not area:
            continue
        x, y = place.tolist()
        w = [(bx - x) * (cy - y) - (by - y) * (cx - x), (cx - x) * (ay - y) - (cy - y) * (ax - x), (ax - x) * (by - y) - (ay - y) * (bx - x)]
        if any(v * area < 0 for v in w):
            continue
        sign = 1 if area > 0 else -1
        empty = True
        for px, py in p:
            m = [(ax - px, ay - py), (bx - px, by - py), (cx - px, cy - py)]
            m = [(u, v, u * u + v * v) for u, v in m]
            det = m[0][0] * (m[1][1] * m[2][2] - m[2][1] * m[1][2]) - m[0][1] * (m[1][0] * m[2][2] - m[2][0] * m[1][2]) + m[0][2] * (m[1][0] * m[2][1] - m[2][0] * m[1][1])
            if sign * det > 0:
                empty = False
                break
        if empty:
            out.append(sum(v * values[k] for v, k in zip(w, three, strict=True)) / area)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_triangles_equal_a_search_of_all(seed):
    rng = np.random.default_rng(seed)
    points = np.unique(rng.integers(0, 30 if seed % 2 else 7, (18, 2)), axis=0)
    points = points[rng.permutation(len(points))]
    values = rng.normal(0, 1, len(points))
    at = np.argwhere(np.ones((9, 9), bool)) * (3 if seed % 2 else 1)
    got = transforms.triangulated(points, values, at)
    for place, v in zip(at, got, strict=True):
        want = brute(points, values, place)
        assert np.isnan(v) if not want else any(abs(v - w) < 1e-9 for w in want), (place, v, want)


def test_planes_are_exact_and_few_points_give_nothing():
    rng = np.random.default_rng(9)
    points = np.unique(rng.integers(-500, 500, (300, 2)), axis=0)
    at = rng.integers(-300, 300, (400, 2))
    plane = lambda p: 3.0 * p[:, 0] - 0.5 * p[:, 1] + 7
    assert np.allclose(transforms.triangulated(points, plane(points), at), plane(at), atol=1e-9)
    assert np.isnan(transforms.triangulated(np.array([[0, 0], [4, 4]]), np.ones(2), np.array([[2, 2]]))).all()
    line = np.array([[0, 0], [2, 2], [4, 4]])
    assert np.isnan(transforms.triangulated(line, np.ones(3), np.array([[1, 1], [1, 2]]))).all()


def test_a_hole_is_filled_as_over_all_pixels():
    """The rim of each hole alone gives what all known pixels give."""
    rng = np.random.default_rng(4)
    y, x = np.indices((12, 14))
    for seed in range(4):
        image = np.random.default_rng(seed).uniform(1, 5, y.shape)
        image[4:7, 3:6] = 900
        image[6, 9:12] = 900
        image[9, 6 + seed % 2] = np.nan
        out = transforms.desaturated(image, 92, grow=0, holes=False)
        mask = image >= np.nanpercentile(image, 92)
        known = np.argwhere(~mask & np.isfinite(image))
        values = image[known[:, 0], known[:, 1]]
        inner = np.argwhere(mask)
        if not np.isnan(transforms.triangulated(known, values, inner)).any():
            for place in inner[rng.permutation(len(inner))[:4]]:
                near = known[(np.abs(known - place) <= 4).all(axis=1)]
                want = brute(near, image[near[:, 0], near[:, 1]], place)
                assert any(abs(out[tuple(place)] - w) < 1e-9 for w in want)
        assert np.isnan(out[9, 6 + seed % 2])
    ramp = 2.0 * y + 3.0 * x
    wide = np.where((y > 3) & (y < 9) & (x > 2) & (x < 11), 5000, ramp)
    assert np.allclose(transforms.desaturated(wide, 80, grow=0), ramp)


def test_nearest_where_a_hole_reaches_the_corner():
    y, x = np.indices((8, 8))
    image = 1.0 * y + 10 * x
    image[:2, :2] = 1e6
    out = transforms.desaturated(image, 95, grow=0)
    assert out[0, 0] in (2.0, 20.0) and out[1, 1] in (12.0, 21.0) and out[5, 5] == 55
