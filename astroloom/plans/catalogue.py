"""All registered queries over the driver's tables, with their SQL twins."""

from __future__ import annotations

from . import exact, extras, mosaics, pixels, sky, upkeep

_PARTS = [sky, pixels, upkeep, extras, mosaics, exact]


def queries() -> dict:
    return {k: f for part in _PARTS for k, f in part.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for part in _PARTS for k, s in part.SQL.items()}
