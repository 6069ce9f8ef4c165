"""Arithmetic on arrays of pixels that stays inside the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def good(pix: Column) -> Column:
    """The finite pixels, as doubles."""
    return F.filter(F.transform(pix, lambda x: x.cast("double")), finite)


def any_set(pix: Column) -> Column:
    return F.exists(pix, lambda x: x != 0)


def let(value: Column, body) -> Column:
    """body(value) with value computed once for a row, not again for each pixel that uses it."""
    return F.transform(F.array(value), body)[0]


def _ends(pix: Column) -> Column:
    return let(good(pix), lambda p: F.struct(F.array_min(p).alias("low"), F.array_max(p).alias("high")))


def min_max(pix: Column) -> Column:
    """To 0..1, null where all are alike."""
    return let(_ends(pix), lambda e: F.transform(pix, lambda x: F.try_divide(x - e.low, e.high - e.low)))


def root_stretch(pix: Column) -> Column:
    return F.transform(min_max(pix), F.sqrt)


def asinh_stretch(pix: Column, a: float = 0.4) -> Column:
    return F.transform(min_max(pix), lambda x: F.asinh(x / a) / F.asinh(F.lit(1 / a)))


def gains(pix: Column, gain: float, top: float = 1.0) -> Column:
    return F.transform(pix, lambda x: F.greatest(F.lit(0.0), F.least(F.lit(top), x * gain)))


def for_display(pix: Column, low: float = -10.0, high: float = 1300.0, tiny: float = 1e-10) -> Column:
    """Zeros, very low, missing and infinite pixels become tiny, very high ones the largest."""
    return let(F.array_max(good(pix)), lambda top: F.transform(pix, lambda x: F.when(~finite(x) | (x == 0) | (x < low), F.lit(tiny)).when(x > high, top).otherwise(x)))


def z_scaled(pix: Column) -> Column:
    """(x - mean) / (std + 1e-6) over the pixels that aren't missing."""

    def about(p: Column) -> Column:
        mean = F.try_divide(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), F.size(p))
        return let(mean, lambda m: F.struct(m.alias("mean"), F.sqrt(F.try_divide(F.aggregate(p, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)), F.size(p))).alias("std")))

    return let(let(good(pix), about), lambda m: F.transform(pix, lambda x: (x - m.mean) / (m.std + 1e-6)))


def percentile_of(pix: Column, share: float) -> Column:
    """Percentile with linear interpolation over the finite pixels; null where there are none."""

    def at(p: Column) -> Column:
        place = (F.size(p) - 1) * share
        low = F.floor(place).cast("int")
        a, b = F.get(p, low), F.get(p, F.ceil(place).cast("int"))
        return a + (b - a) * (place - low)

    return let(F.array_sort(good(pix)), at)


def percentile_stretch(pix: Column, low: float = 0.01, high: float = 0.98, a: float = 0.01) -> Column:
    """Between two percentiles to 0..1, values outside clipped, then the asinh stretch; null where both are alike."""
    ends = F.struct(percentile_of(pix, low).alias("low"), percentile_of(pix, high).alias("high"))
    unit = lambda x, e: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(x - e.low, e.high - e.low)))
    return let(ends, lambda e: F.transform(pix, lambda x: F.when(e.high > e.low, F.asinh(unit(x, e) / a) / F.asinh(F.lit(1 / a)))))
