"""Catalogues of objects: CSV files with a header, and the choice among sources.

Defined results: a value that isn't of its type is null; a file with a header
alone gives no rows; columns that `types` doesn't name stay strings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import coordinates

KEYS = ("ID", "ra", "dec")


def csv(spark: SparkSession, path: str | list[str], types: dict[str, str] | None = None) -> DataFrame:
    """A CSV file with a header. Types are given, not inferred, so that an empty column keeps its type and nothing is read twice."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*(F.col(f"`{c}`").try_cast((types or {}).get(c, "string")).alias(c) for c in raw.columns))


def catalogue(spark: SparkSession, coords: list[float] | None = None, path: str | None = None, union: Callable[[], DataFrame] | None = None, default: str | None = None, keys: tuple[str, str, str] | None = None, types: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """A catalogue with ID, ra and dec, and its name: of coordinates, a CSV file, the surveys' own union or a default file, the first that is given.

    keys: the file's names of ID, ra and dec, where they differ from those."""
    if coords is not None:
        return coordinates(spark, coords), "coordinates"
    if path is None and union is not None:
        return union(), ""
    path = path or default
    if path is None:
        raise ValueError("no source of objects is given")
    own = keys or KEYS
    raw = csv(spark, path, types)
    if missing := [k for k in own if k not in raw.columns]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    kinds = {"ID": (types or {}).get(own[0], "string"), "ra": "double", "dec": "double"}
    named = raw.withColumnsRenamed(dict(zip(own, KEYS, strict=True)))
    name = path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]
    return named.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items()}), name
