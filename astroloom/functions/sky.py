"""Sky geometry as Column expressions. Angles are in degrees."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the survey's tile grid: degrees per pixel, pixels per side, reference pixel.
SCALE, SIDE, CENTRE = 5.160234650248e-05, 10_000, 5_000.0


def tile_numbers(ra: Column, dec: Column) -> tuple[Column, Column]:
    """Grid numbers of a position, truncated toward zero."""
    return (ra * 2 * F.cos(F.radians(dec))).cast("int"), ((dec + 90) * 2).cast("int")


def tile_centre(x: Column, y: Column, digits: int = 12) -> tuple[Column, Column]:
    """ra and dec of a tile's centre, rounded half to even."""
    dec = y / F.lit(2.0) - 90
    return F.bround(F.try_divide(x / F.lit(2.0), F.cos(F.radians(dec))), digits), F.bround(dec, digits)


def tile_name(x: Column, y: Column) -> Column:
    return F.concat(F.lit("("), x.cast("string"), F.lit(", "), y.cast("string"), F.lit(")"))


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    r, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(r), F.cos(d) * F.sin(r), F.sin(d)


def unit_vector_c(ra: Column, dec: Column) -> Column:
    """unit_vector as a struct of x, y and z with the C library's sine and cosine, to the last bit.

    The JVM's differ in the last bit for one angle in 500, and that bit decides a match at the very radius."""

    @F.pandas_udf("x double, y double, z double")
    def vectors(r: pd.Series, d: pd.Series) -> pd.DataFrame:
        r, d = r.to_numpy(float), d.to_numpy(float)
        return pd.DataFrame({"x": np.cos(d) * np.cos(r), "y": np.cos(d) * np.sin(r), "z": np.sin(d)})

    return F.when(ra.isNotNull() & dec.isNotNull(), vectors(F.radians(ra), F.radians(dec)))


def chord(a: tuple, b: tuple) -> Column:
    """Distance of two unit vectors through the sphere."""
    return F.sqrt(sum(((p - q) * (p - q) for p, q in zip(a[1:], b[1:], strict=True)), (a[0] - b[0]) * (a[0] - b[0])))


def separation(chord_: Column) -> Column:
    """Angle for a chord, in arc seconds."""
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), chord_ / 2))) * 3600


def plane(ra: Column, dec: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """Gnomonic plane coordinates around (ra0, dec0); null on the far side of the sphere."""
    d, d0, dr = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    front = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(dr)
    over = F.when(front > 0, front)
    xi = F.cos(d) * F.sin(dr) / over
    eta = (F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(dr)) / over
    return F.degrees(xi), F.degrees(eta)


def pixel(ra: Column, dec: Column, ra0: Column, dec0: Column, scale: float = SCALE, centre: float = CENTRE) -> tuple[Column, Column]:
    """Pixel on a tile, counted from one."""
    xi, eta = plane(ra, dec, ra0, dec0)
    return centre - xi / scale, centre + eta / scale


def pixel_of_header(ra: Column, dec: Column, crval: tuple, crpix: tuple, cd: tuple) -> tuple[Column, Column]:
    """Pixel for a file's own header: reference position and pixel, and the four entries of its CD matrix."""
    xi, eta = plane(ra, dec, *crval)
    a, b, c, d = cd
    det = a * d - b * c
    return crpix[0] + (d * xi - b * eta) / det, crpix[1] + (a * eta - c * xi) / det


def on_tile(x: Column, y: Column) -> Column:
    return (x > 0) & (x < SIDE) & (y > 0) & (y < SIDE)


def arcsec_of_kpc(kpc: Column, mpc: Column) -> Column:
    return F.degrees(kpc / (mpc * 1000)) * 3600


def kpc_of_arcsec(arcsec: Column, mpc: Column) -> Column:
    return F.radians(arcsec / 3600) * mpc * 1000


def rescaled(flux: Column, current: Column, standard: Column) -> Column:
    """Flux moved from one photometric zero point to another."""
    return flux * F.pow(F.lit(10.0), (current - standard) * -0.4)
