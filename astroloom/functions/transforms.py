"""Whole images in a task: wavelet and Fourier anomalies, background, colour composites.

Small numpy helpers; operators.anomalies applies them to the images of a
DataFrame, one image at a time within a task."""

from __future__ import annotations

import numpy as np


def haar(image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Approximation, horizontal, vertical and diagonal detail of 2 x 2 squares; an odd last row or column is repeated."""
    even = np.pad(image.astype(float), [(0, n % 2) for n in image.shape], mode="edge")
    a, b, c, d = even[::2, ::2], even[::2, 1::2], even[1::2, ::2], even[1::2, 1::2]
    return (a + b + c + d) / 2, (a + b - c - d) / 2, (a - b + c - d) / 2, (a - b - c + d) / 2


def united(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that links (a, b) join it to; all nodes jump to the least one until none moves."""
    least = np.arange(n)
    while True:
        was = least.copy()
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, least[a], low)
        np.minimum.at(least, least[b], low)
        least = least[least]
        if (least == was).all():
            return least


def components(mask: np.ndarray) -> np.ndarray:
    """Number of each set pixel's component (sides touch), from 1 in reading order; 0 elsewhere.

    Neighbours in a row and those above each other are united."""
    flat = np.where(mask, np.arange(mask.size).reshape(mask.shape), -1)
    pairs = [(flat[:, 1:], flat[:, :-1]), (flat[1:], flat[:-1])]
    a, b = (np.concatenate([p[k][(p[0] >= 0) & (p[1] >= 0)] for p in pairs]) for k in (0, 1))
    least = united(mask.size, a, b)
    out = np.zeros(mask.shape, np.int64)
    out[mask] = np.unique(least[flat[mask]], return_inverse=True)[1] + 1
    return out


def dilated(mask: np.ndarray, times: int = 1) -> np.ndarray:
    """Grown by the four neighbours, `times` over."""
    for _ in range(times):
        p = np.pad(mask, 1)
        mask = p[1:-1, 1:-1] | p[:-2, 1:-1] | p[2:, 1:-1] | p[1:-1, :-2] | p[1:-1, 2:]
    return mask


def filled(mask: np.ndarray) -> np.ndarray:
    """With holes set: unset pixels that no path of unset ones joins to the border."""
    label = components(~np.pad(mask, 1))
    return (label != label[0, 0])[1:-1, 1:-1]


def haar_anomaly(image: np.ndarray, threshold: float = 0.0025, least: int = 50, dilate: int = 0) -> tuple[list[bool], np.ndarray]:
    """Whether diagonal, horizontal and vertical detail has a flat patch of `least` coefficients or more, and the pixels under such patches."""
    _, across, down, diagonal = haar(image)
    found, mask = [], np.zeros(across.shape, bool)
    for detail in (diagonal, across, down):
        label = components(np.abs(detail) <= threshold)
        big = np.bincount(label.ravel()) >= least
        big[0] = False
        found.append(bool(big.any()))
        mask |= big[label]
    mask = np.kron(mask, np.ones((2, 2), bool))[: image.shape[0], : image.shape[1]]
    return found, dilated(mask, dilate)


def haar_levels(image: np.ndarray, levels: int, threshold: float = 0.0025, least: int = 50) -> list[list[bool]]:
    """For the image, then its approximation, and so on: whether horizontal, vertical and diagonal detail has a flat patch."""
    out = []
    for _ in range(levels):
        diagonal, across, down = haar_anomaly(image, threshold, least)[0]
        out.append([across, down, diagonal])
        image = haar(image)[0]
    return out


def smoothed(m: np.ndarray) -> np.ndarray:
    """Under a Gaussian of one pixel, nine pixels wide; zeros lie beyond the border."""
    kernel = np.exp(-0.5 * np.arange(-4, 5) ** 2)
    kernel /= kernel.sum()
    for axis in (0, 1):
        p = np.pad(m, [(4, 4) if k == axis else (0, 0) for k in (0, 1)])
        m = sum(w * np.take(p, np.arange(k, k + m.shape[axis]), axis=axis) for k, w in enumerate(kernel))
    return m


def spectrum(image: np.ndarray, smooth: bool = False, log: bool = False) -> np.ndarray:
    """Magnitudes with the zero frequency in the middle, smoothed or as log(1 + m) if asked for."""
    m = np.abs(np.fft.fftshift(np.fft.fft2(image)))
    m = smoothed(m) if smooth else m
    return np.log1p(m) if log else m


def fourier_areas(rows: int, cols: int, arms: tuple[int, int, int] | None = None) -> dict[str, list[tuple[slice, slice]]]:
    """Vertical arms (the middle columns at the upper and lower edge), horizontal arms and corners of a spectrum. arms: half an arm's width, its length, a corner's side.

    The arms start at the edges, so on images larger than two arms the zero frequency lies in none."""
    half, length, corner = arms or ((10, 3000, 3000) if cols > 500 else (1, 80, 80))
    ends = lambda n, k: (slice(0, min(k, n)), slice(max(n - k, 0), n))
    middle = lambda n: slice(max(n // 2 - half, 0), n // 2 + half + 1)
    return {
        "vertical": [(r, middle(cols)) for r in ends(rows, length)],
        "horizontal": [(middle(rows), c) for c in ends(cols, length)],
        "corners": [(r, c) for r in ends(rows, corner) for c in ends(cols, corner)],
    }


def fourier_anomaly(image: np.ndarray, factor: float = 3.0, smooth: bool = False, arms: tuple[int, int, int] | None = None) -> tuple[float, float, float, bool]:
    """Mean magnitude over the vertical arms, the horizontal arms and the corners; an anomaly if both are over `factor` times the corners."""
    m = spectrum(np.nan_to_num(image, nan=0.0, posinf=0.0, neginf=0.0), smooth)
    if not m.size:
        return (float("nan"),) * 3 + (False,)
    mean = lambda areas: float(sum(m[a].sum() for a in areas) / sum(m[a].size for a in areas))
    vertical, horizontal, corners = (mean(a) for a in fourier_areas(*m.shape, arms).values())
    return vertical, horizontal, corners, bool(vertical > factor * corners and horizontal > factor * corners)


def mesh_squares(image: np.ndarray, mesh: int, sigma: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Level and scatter of each mesh square after clipping; NaN where no pixel has a value.

    The level is 2.5 medians less 1.5 means, or the median where the two are far apart."""
    rows, cols = (-(-n // mesh) for n in image.shape)
    level, rms = np.full((rows, cols), np.nan), np.full((rows, cols), np.nan)
    for i in range(rows):
        for j in range(cols):
            v = image[i * mesh : (i + 1) * mesh, j * mesh : (j + 1) * mesh].ravel().astype(float)
            v = v[np.isfinite(v)]
            for _ in range(rounds):
                keep = np.abs(v - np.median(v)) <= sigma * v.std() if len(v) else np.zeros(0, bool)
                if keep.all():
                    break
                v = v[keep]
            if len(v):
                mean, middle, rms[i, j] = v.mean(), np.median(v), v.std()
                level[i, j] = 2.5 * middle - 1.5 * mean if rms[i, j] == 0 or abs(mean - middle) < 0.3 * rms[i, j] else middle
    return level, rms


def _meshes(image: np.ndarray, mesh: int, sigma: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Level and scatter of each mesh square, each the median of its 3 x 3 neighbours."""
    level, rms = mesh_squares(image, mesh, sigma, rounds)
    return _around(level), _around(rms)


def _around(x: np.ndarray) -> np.ndarray:
    """The median of each square and its neighbours, squares without a value left out."""
    p = np.pad(x, 1, constant_values=np.nan)
    around = np.stack([p[i : i + x.shape[0], j : j + x.shape[1]] for i in range(3) for j in range(3)])
    some, out = np.isfinite(around).any(axis=0), np.full(x.shape, np.nan)
    out[some] = np.nanmedian(around[:, some], axis=0)
    return out


def background_rms(image: np.ndarray, mesh: int = 128, sigma: float = 3.0, rounds: int = 10) -> float:
    """Median over mesh squares of the scatter that is left after clipping."""
    rms = _meshes(image, mesh, sigma, rounds)[1]
    return float(np.median(rms[np.isfinite(rms)])) if np.isfinite(rms).any() else float("nan")


def background(image: np.ndarray, mesh: int = 128, sigma: float = 3.0, rounds: int = 10) -> tuple[np.ndarray, float]:
    """Level of each pixel, a bicubic spline through the middles of the mesh squares, and the median scatter."""
    level, rms = _meshes(image, mesh, sigma, rounds)
    if not np.isfinite(level).any():
        return np.zeros(image.shape), float("nan")
    rows, cols = (np.arange(n) for n in image.shape)
    return spline(level, mesh, rows, cols), float(np.median(rms[np.isfinite(rms)]))


def spline(level: np.ndarray, mesh: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """A bicubic spline through the middles of mesh squares, at these rows and columns of pixels; mirrored at the border. Squares without a level take the median of all."""
    level = np.where(np.isfinite(level), level, np.nanmedian(level))

    def weights(n: int, at: np.ndarray) -> np.ndarray:
        """What each square's level adds to a pixel: cubic pieces times the inverse of the spline's own matrix."""
        own = np.diag(np.full(n, 4 / 6)) + np.diag(np.full(n - 1, 1 / 6), 1) + np.diag(np.full(n - 1, 1 / 6), -1)
        own[0, 0] += 1 / 6
        own[-1, -1] += 1 / 6
        x = (at + 0.5) / mesh - 0.5
        low = np.floor(x).astype(int)
        t = x - low
        pieces = ((1 - t) ** 3 / 6, (3 * t**3 - 6 * t**2 + 4) / 6, (-3 * t**3 + 3 * t**2 + 3 * t + 1) / 6, t**3 / 6)
        out = np.zeros((len(at), n))
        for k, piece in enumerate(pieces):
            j = (low + k - 1) % (2 * n)
            np.add.at(out, (np.arange(len(at)), np.where(j < n, j, 2 * n - 1 - j)), piece)
        return out @ np.linalg.inv(own)

    return weights(level.shape[0], rows) @ level @ weights(level.shape[1], cols).T


def background_removed(image: np.ndarray, seed: int, mesh: int = 128, least: float = -0.1) -> np.ndarray:
    """image less its background; missing pixels and those under `least` become noise of the background's scatter, the same for one seed."""
    level, rms = background(image, mesh)
    out = image - level
    mask = np.isnan(image) | (out < least)
    return np.where(mask, np.random.default_rng(seed).normal(0, np.nan_to_num(rms), image.shape), out)


def composite(channels: np.ndarray, scaling: str = "linear", stretch: float = 0.5, q: float = 10.0, floor: float = 0.0, ceiling: float = 99.8, gamma: float | None = 0.35, norm: bool = True, gains: tuple = (1.0, 1.0, 1.0)) -> np.ndarray:
    """Red, green and blue (3, rows, cols): scaled, under gamma, then each channel to its own percentile and gain, as whole numbers 0..255.

    Without norm the scaled channels as they are, in floating point. A pixel that has no value becomes 0, as does a negative one under gamma."""
    c = channels.astype(float)
    light = c.sum(axis=0) / 3
    top = lambda x: np.nanpercentile(x, ceiling) if not np.isnan(x).all() else np.nan
    with np.errstate(all="ignore"):
        if scaling == "linear":
            c = c / top(light) * 255
        elif scaling == "asinh":
            c = c * np.arcsinh(stretch * q * (light - floor)) / (q * light)
        else:
            raise ValueError(f"unknown scaling {scaling}")
        if gamma is not None:
            c = np.clip(c**gamma, 0, 255)
        if not norm:
            return c
        c = np.stack([g * np.clip(x / top(x) * 255, 0, 255) for x, g in zip(c, gains, strict=True)])
    return np.nan_to_num(np.clip(c, 0, 255), nan=0.0).astype(np.uint8)


def percentile_for(values: np.ndarray, target: float) -> float:
    """The first percentile from 100 down to 0.01, in steps of 0.01, whose value is at most target; else 100."""
    steps = np.arange(100, 0, -0.01)
    at = np.flatnonzero(np.nanpercentile(values, steps) <= target)
    return float(steps[at[0]]) if len(at) else 100.0


def saturated(image: np.ndarray, percentile: float, grow: int = 2, holes: bool = True, negatives: bool = False, least: int = 10) -> np.ndarray:
    """Pixels at or over a percentile, grown; with patches of `least` or more low pixels (at most 0.9), grown by one, if asked for; with holes."""
    mask = dilated(image >= np.nanpercentile(image, percentile), grow)
    if negatives:
        label = components(image <= 0.9)
        big = np.bincount(label.ravel()) >= least
        big[0] = False
        mask = mask | dilated(big[label], 1)
    return filled(mask) if holes else mask


def _turn(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Twice the area of triangles a, b, c, above zero where they turn from the first axis to the second."""
    return (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])


def _side(a: np.ndarray, b: np.ndarray, q: np.ndarray, sign: int, far: int) -> np.ndarray:
    """On which side of the line from a to b the place q lies once it is moved by next to nothing along sign * (1, far); never on it."""
    turn = _turn(a, b, q)
    moved = sign * ((b[..., 0] - a[..., 0]) * far - (b[..., 1] - a[..., 1]))
    return np.where(turn != 0, np.sign(turn), np.sign(moved))


def _holds(x: np.ndarray, y: np.ndarray, z: np.ndarray, q: np.ndarray, sign: int, far: int) -> np.ndarray:
    """Whether triangles hold the places, moved as above."""
    area = np.sign(_turn(x, y, z))
    return (area != 0) & (_side(x, y, q, sign, far) == area) & (_side(y, z, q, sign, far) == area) & (_side(z, x, q, sign, far) == area)


def _around_triangle(points: np.ndarray, at: np.ndarray, sign: int, far: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place a triangle of points that holds it (three numbers of points), and whether there is one.

    From the first point, the last one within half a turn and the first one beyond it."""
    d = points[None] - (at + sign * 1e-6 * np.array([1 / far, 1]))[:, None]
    angle = np.arctan2(d[..., 1], d[..., 0])
    angle = np.mod(angle - angle[:, :1], 2 * np.pi)
    b, c = np.where(angle <= np.pi, angle, -1).argmax(axis=1), np.where(angle > np.pi, angle, 9).argmin(axis=1)
    three = np.stack([np.zeros(len(at), int), b, c], axis=1)
    return three, _holds(*(points[three[:, k]] for k in range(3)), at, sign, far)


def triangulated(points: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Values at places, linear over the Delaunay triangle of points that holds each; NaN outside all. points, at: whole numbers (n x 2), no point twice.

    A place starts in any triangle around it. While a point lies within the triangle's circle, the one farthest inside takes
    the place of that corner which leaves the place in the triangle; every step lowers the lifted triangle over the place, so there is an end.
    So that no place is on a side, each counts as moved by next to nothing, one way and, where that leaves all triangles, the other."""
    points, at = points.astype(np.int64), at.astype(np.int64)
    out = np.full(len(at), np.nan)
    if len(points) < 3:
        return out
    far = int(max(np.ptp(points[:, 0]), np.ptp(points[:, 1]))) + 1
    step = max(1, 1_000_000 // len(points))
    for sign in (1, -1):
        left = np.flatnonzero(np.isnan(out))
        for k in range(0, len(left), step):
            out[left[k : k + step]] = _over_triangles(points, values, at[left[k : k + step]], sign, far)
    left = np.flatnonzero(np.isnan(out))
    for k in range(0, len(left), step):  # a point itself, at a corner of all
        place, point = np.nonzero((points[None] == at[left[k : k + step], None]).all(axis=-1))
        out[left[k + place]] = values[point]
    return out


def _over_triangles(points: np.ndarray, values: np.ndarray, own: np.ndarray, sign: int, far: int) -> np.ndarray:
    lifted = (points**2).sum(axis=1)
    three, inside = _around_triangle(points, own, sign, far)
    todo = np.flatnonzero(inside)
    while len(todo):
        t, q = three[todo], own[todo]
        a, b, c = (points[t[:, i]] for i in range(3))
        d = points[None] - a[:, None]
        h = lifted[None] - lifted[t[:, :1]] - 2 * (a[:, None] * d).sum(axis=-1)
        (bx, by), (cx, cy) = (b - a).T, (c - a).T
        hb, hc = ((v - a) ** 2 for v in (b, c))
        hb, hc = hb.sum(axis=1), hc.sum(axis=1)
        # how far each point lies under the plane through the lifted corners, times the triangle's area
        under = d[..., 0] * (by * hc - cy * hb)[:, None] - d[..., 1] * (bx * hc - cx * hb)[:, None] + h * (bx * cy - by * cx)[:, None]
        under *= np.sign(_turn(a, b, c))[:, None]
        p = under.argmin(axis=1)
        worse = under[np.arange(len(todo)), p] < 0
        todo, t, q, p = todo[worse], t[worse], q[worse], p[worse]
        chosen = np.zeros(len(todo), bool)
        for i in range(3):
            new = t.copy()
            new[:, i] = p
            holds = ~chosen & _holds(*(points[new[:, j]] for j in range(3)), q, sign, far)
            three[todo[holds]] = new[holds]
            chosen |= holds
        todo = todo[chosen]
    out = np.full(len(own), np.nan)
    x, y, z = (points[three[inside, j]] for j in range(3))
    q, area = own[inside], _turn(x, y, z).astype(float)
    weights = np.stack([_turn(q, y, z), _turn(x, q, z), _turn(x, y, q)], axis=1) / area[:, None]
    out[inside] = (weights * values[three[inside]]).sum(axis=1)
    return out


def nearest_values(points: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The value of the point nearest to each place, of several the first."""
    step = max(1, 1_000_000 // max(1, len(points)))
    return np.concatenate([values[((points[None] - at[k : k + step, None]) ** 2).sum(axis=-1).argmin(axis=1)] for k in range(0, len(at), step)]) if len(at) else np.zeros(0)


def _holes(known: np.ndarray) -> np.ndarray:
    """Numbers of patches of unknown pixels, corners touching, 0 elsewhere."""
    flat = np.where(known, -1, np.arange(known.size).reshape(known.shape))
    pairs = [(flat[:, 1:], flat[:, :-1]), (flat[1:], flat[:-1]), (flat[1:, 1:], flat[:-1, :-1]), (flat[1:, :-1], flat[:-1, 1:])]
    a, b = (np.concatenate([p[k][(p[0] >= 0) & (p[1] >= 0)] for p in pairs]) for k in (0, 1))
    least = united(known.size, a, b)
    out = np.zeros(known.shape, np.int64)
    out[~known] = np.unique(least[flat[~known]], return_inverse=True)[1] + 1
    return out


def desaturated(image: np.ndarray, percentile: float, grow: int = 2, holes: bool = True, negatives: bool = False, least: int = 10) -> np.ndarray:
    """Saturated pixels are interpolated over the Delaunay triangles of the others; if one of them lies in no triangle, all take the value of the nearest pixel.

    The triangles over a hole have their corners in its rim, so each hole is filled from its own. Missing pixels have no value and stay."""
    if not np.isfinite(image).any():
        return image.copy()
    mask = saturated(image, percentile, grow, holes, negatives, least)
    known = ~mask & np.isfinite(image)
    if mask.all() or not known.any() or not mask.any():
        return image.copy()
    hole, out = _holes(known), image.astype(float)
    order = np.argsort(hole, axis=None, kind="stable")
    edges = np.searchsorted(hole.ravel()[order], np.arange(1, hole.max() + 2))
    parts = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        pixels = np.stack(np.unravel_index(order[a:b], hole.shape), axis=1)
        at = pixels[mask[pixels[:, 0], pixels[:, 1]]]
        if not len(at):
            continue
        (top, left), (bottom, right) = pixels.min(axis=0) - 1, pixels.max(axis=0) + 1
        top, left = max(top, 0), max(left, 0)
        own = np.pad(hole[top : bottom + 1, left : right + 1] == hole[tuple(pixels[0])], 1)
        near = np.zeros(own.shape, bool)
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                near |= np.roll(own, (dy, dx), (0, 1))
        rim = np.argwhere(near[1:-1, 1:-1] & known[top : bottom + 1, left : right + 1]) + (top, left)
        parts.append((at, rim, out[rim[:, 0], rim[:, 1]]))
    found = [triangulated(rim, values, at) for at, rim, values in parts]
    if any(np.isnan(v).any() for v in found):
        found = [nearest_values(rim, values, at) for at, rim, values in parts]
    for (at, _, _), v in zip(parts, found, strict=True):
        out[at[:, 0], at[:, 1]] = v
    return np.where(mask, out, image).astype(image.dtype)


#: Fixed values of the colour chooser: the percentile looked at, the bounds that tell of saturation, and the targets under them.
LOOK, SATURATED, STRONGLY, TARGET, STRONG_TARGET = 99.9, 1000.0, 20000.0, 1000.0, 200.0


def chosen_colours(channels: np.ndarray) -> np.ndarray:
    """Red, green and blue (3, rows, cols) ready for display: desaturated first if one of them is bright, turned upside down last."""
    c = channels.astype(float)
    bright = max(np.nanpercentile(x, LOOK) if not np.isnan(x).all() else -np.inf for x in c)
    if bright > SATURATED:
        target = STRONG_TARGET if bright > STRONGLY else TARGET
        c = np.stack([desaturated(x, percentile_for(x, target)) for x in c])
    return composite(c, "linear", stretch=0.9, q=5)[:, ::-1]
