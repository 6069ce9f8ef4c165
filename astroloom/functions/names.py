"""Names of files, tiles and bands as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded(number: Column, digits: int) -> Column:
    """Zeros to the left; longer numbers stay whole."""
    s = number.cast("string")
    return F.when(F.length(s) < digits, F.lpad(s, digits, "0")).otherwise(s)


def tile_file(x: Column, y: Column, prefix: str, suffix: str, delimiter: str = ".", digits: int = 0) -> Column:
    return F.concat(F.lit(prefix + delimiter), padded(x, digits), F.lit(delimiter), padded(y, digits), F.lit(suffix))


def numbers_in(name: Column) -> Column:
    """All numbers of a file name that stand between its delimiters, as an array of int."""
    dotted = F.regexp_extract_all(name, F.lit(r"(?<=\.)(\d+)(?=\.)"), 1)
    scored = F.regexp_extract_all(name, F.lit(r"(?<=[_-])(\d+)(?=[_.])"), 1)
    return F.transform(F.when(name.startswith("calexp"), scored).otherwise(dotted), lambda s: s.cast("int"))


def cutout_tile(name: Column) -> Column:
    """Struct of the two leading numbers of a cutout file's name; null where there are none."""
    part = F.split(name, "_")
    x, y = (F.get(part, F.lit(k)).try_cast("int") for k in (0, 1))
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("xxx"), y.alias("yyy")))


def parsed_tuple(s: Column) -> Column:
    return F.transform(F.regexp_extract_all(s, F.lit(r"(\d+)"), 1), lambda v: v.cast("int"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def bands_of_path(path: Column, size: int = 224) -> Column:
    return F.regexp_extract(path, rf"{size}x{size}_(.*?)_batch", 1)


def band_indices(bands: Column, order: list[str]) -> Column:
    """Positions of band letters in the order of a registry, sorted, -1 for unknown ones."""
    known = F.array(*(F.lit(b) for b in order))
    return F.array_sort(F.transform(bands, lambda b: (F.array_position(known, b) - 1).cast("int")))
