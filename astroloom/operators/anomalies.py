"""Anomalies, background and colour of the images of a DataFrame, one row per image.

Each image is a row (ny, nx, pix, row by row): a cutout, or a tile small enough for
a task. Nothing is shuffled: tasks map Arrow batches. `key` columns pass through.

Defined results: a null or empty pix gives null results; missing and infinite
pixels are never flat, count as zero in a spectrum and are left out of a
background; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..functions import transforms


def _each(images: DataFrame, key: list[str], extra: list[str], schema: str, made: Callable[..., tuple], width: int) -> DataFrame:
    """key and the values of `made(image, *extra)`; `width` of them."""
    kept = images.select(*key, *extra, "ny", "nx", "pix")
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*key).schema.fields)
    names = [part.split()[0] for part in schema.split("; ")]

    def rows(batches):
        for pdf in batches:
            out = []
            for row in pdf[["ny", "nx", "pix", *extra]].itertuples(index=False):
                ny, nx, pix, *more = row
                if pix is None or len(pix) == 0:
                    out.append((None,) * width)
                else:
                    out.append(made(np.asarray(pix, np.float32).reshape(int(ny), int(nx)), *more))
            yield pd.concat((pdf[key], pd.DataFrame(out, columns=names, index=pdf.index, dtype=object)), axis=1)

    return kept.mapInPandas(rows, f"{typed}, {schema.replace('; ', ', ')}")


def haar_anomalies(images: DataFrame, key: list[str], threshold: float = 0.0025, least: int = 50, dilate: int = 0) -> DataFrame:
    """key, diagonal, horizontal, vertical (is there a flat patch) and mask (its pixels, row by row)."""

    def made(image):
        found, mask = transforms.haar_anomaly(image, threshold, least, dilate)
        return *found, mask.ravel().tolist()

    return _each(images, key, [], "diagonal boolean; horizontal boolean; vertical boolean; mask array<boolean>", made, 4)


def haar_levels(images: DataFrame, key: list[str], levels: int = 2, threshold: float = 0.0025, least: int = 50) -> DataFrame:
    """key and found: for each level whether horizontal, vertical and diagonal detail has a flat patch."""
    return _each(images, key, [], "found array<array<boolean>>", lambda image: (transforms.haar_levels(image, levels, threshold, least),), 1)


def fourier_anomalies(images: DataFrame, key: list[str], factor: float = 3.0, smooth: bool = False) -> DataFrame:
    """key, vertical, horizontal, corners (mean magnitudes) and anomaly."""
    return _each(images, key, [], "vertical double; horizontal double; corners double; anomaly boolean", lambda image: transforms.fourier_anomaly(image, factor, smooth), 4)


def spectra(images: DataFrame, key: list[str], smooth: bool = False, log: bool = True) -> DataFrame:
    """key and pix: magnitudes of the spectrum, the zero frequency in the middle."""
    clean = lambda image: np.nan_to_num(image, nan=0.0, posinf=0.0, neginf=0.0)
    return _each(images, key, [], "pix array<double>", lambda image: (transforms.spectrum(clean(image), smooth, log).ravel().tolist(),), 1)


def backgrounds(images: DataFrame, key: list[str], mesh: int = 128) -> DataFrame:
    """key and rms."""
    return _each(images, key, [], "rms double", lambda image: (transforms.background_rms(image, mesh),), 1)


def replaced(images: DataFrame, key: list[str], seed: str, threshold: float = 0.0025, least: int = 50, dilate: int = 1, mesh: int = 128) -> DataFrame:
    """key and pix, with noise of the background's scatter in flat patches. seed: a column of whole numbers, so that a task that runs again makes the same noise."""

    def made(image, number):
        _, mask = transforms.haar_anomaly(image, threshold, least, dilate)
        rms = np.nan_to_num(transforms.background_rms(image, mesh))
        noise = np.random.default_rng(abs(int(number))).normal(0, rms, image.shape)
        return (np.where(mask, noise, image).ravel().astype(float).tolist(),)

    return _each(images, key, [seed] if seed not in key else [], "pix array<float>", made, 1) if seed not in key else _each(images.withColumn("_seed", images[seed]), key, ["_seed"], "pix array<float>", made, 1)


def background_removed(images: DataFrame, key: list[str], seed: str, mesh: int = 128, least: float = -0.1) -> DataFrame:
    """key and pix less the background, with noise for missing and very low pixels. seed: a column of whole numbers, as for replaced()."""
    made = lambda image, number: (transforms.background_removed(image.astype(float), abs(int(number)), mesh, least).ravel().tolist(),)
    return _each(images.withColumn("_seed", images[seed]), key, ["_seed"], "pix array<double>", made, 1)


def _channels(image: np.ndarray) -> np.ndarray:
    return image.reshape(3, image.shape[0] // 3, image.shape[1])


def composites(images: DataFrame, key: list[str], scaling: str = "linear", **options) -> DataFrame:
    """key and rgb (rows x columns x 3, as bytes). images: ny, nx and pix with the red, green and blue pixels one after the other; ny counts all three."""
    return _each(images, key, [], "rgb binary", lambda image: (transforms.composite(_channels(image), scaling, **options).transpose(1, 2, 0).tobytes(),), 1)


def colours(images: DataFrame, key: list[str]) -> DataFrame:
    """key and rgb as composites() gives them, desaturated where a channel is bright and turned upside down for display."""
    return _each(images, key, [], "rgb binary", lambda image: (transforms.chosen_colours(_channels(image)).transpose(1, 2, 0).tobytes(),), 1)


def desaturated(images: DataFrame, key: list[str], percentile: float, negatives: bool = False, least: int = 10) -> DataFrame:
    """key and pix, with saturated pixels interpolated over the triangles of the pixels around them."""
    return _each(images, key, [], "pix array<float>", lambda image: (transforms.desaturated(image, percentile, negatives=negatives, least=least).ravel().tolist(),), 1)
