"""Spectra and Fourier anomalies of whole tiles, from their blocks.

An image is rows (image columns, by, bx, h, w, pix) as operators.images has them. The transform takes two passes: a task has the blocks of
one `by`, transforms their pixel rows and cuts the result into groups of columns; a shuffle turns the image, and a task has a group of
columns over all rows. As pixels are real, only columns of frequencies from zero up move; the others are their mirror, point by point. A tile
of 10 000 x 10 000 pixels is 20 tasks of 41 MB, then 20 of 41 MB, and 0.8 GB move between the passes.

Defined results: missing and infinite pixels count as zero, as do absent blocks and those whose pix is null or empty; an image ends where its
last block ends; an image of which no block has pixels has no rows; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import transforms
from .images import BLOCK

#: Columns of a group, and how far the smoothing kernel reaches.
COLUMNS, REACH = 256, 4


def _typed(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema.fields)


def _row_pass(blocks: DataFrame, image: list[str], reach: int, columns: int, block: int) -> DataFrame:
    """Image columns, rows and cols (the image's sides), part (group of columns), low (its first frequency, neighbours included), by, h and line: complex numbers, row by row."""
    kept = blocks.where(F.size("pix") > 0)
    sides = kept.groupBy(*image).agg(F.max(F.col("by") * block + F.col("h")).alias("rows"), F.max(F.col("bx") * block + F.col("w")).alias("cols"))
    whole = kept.select(*image, "by", "bx", "h", "w", "pix").join(sides, image)
    schema = StructType.fromDDL(f"{_typed(blocks, image)}, rows int, cols int, part int, low int, by int, h int, line binary")
    want = to_arrow_schema(schema)

    def transform(table):
        import pyarrow as pa

        first = {c: table.column(c)[0].as_py() for c in (*image, "rows", "cols", "by")}
        high, cols = max(table.column("h").to_pylist()), first["cols"]
        strip = np.zeros((high, cols))
        for batch in table.to_batches():
            for k in range(batch.num_rows):
                pix = batch.column("pix").slice(k, 1).flatten().to_numpy(zero_copy_only=False)
                h, w, x = batch.column("h")[k].as_py(), batch.column("w")[k].as_py(), batch.column("bx")[k].as_py() * block
                strip[:h, x : x + w] = pix.reshape(h, w)
        half = np.fft.rfft(np.nan_to_num(strip, nan=0.0, posinf=0.0, neginf=0.0), axis=1)
        out = []
        for start in range(0, half.shape[1], columns):
            low = max(0, start - reach)
            cut = half[:, low : start + columns + reach]
            out.append(first | {"part": start // columns, "low": low, "h": high, "line": np.ascontiguousarray(cut).tobytes()})
        return pa.Table.from_pylist(out, schema=want)

    return whole.groupBy(*image, "by").applyInArrow(transform, schema)


def _windows(table, columns: int, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """First column and magnitudes of the two parts of a spectrum, its zero frequency in the middle, that a group of columns makes: its own and their mirror."""
    rows, cols, part, low = (table.column(c)[0].as_py() for c in ("rows", "cols", "part", "low"))
    width = min(cols // 2 + 1, (part + 1) * columns + reach) - low
    half, block = np.zeros((rows, width), complex), table.column("block")[0].as_py()
    for batch in table.to_batches():
        for k in range(batch.num_rows):
            line = np.frombuffer(batch.column("line")[k].as_py(), complex).reshape(-1, width)
            at = batch.column("by")[k].as_py() * block
            half[at : at + len(line)] = line
    own = np.abs(np.fft.fft(half, axis=0))
    mirror = np.roll(own[::-1], 1, axis=0)  # the row of frequency -u stands at u
    own, mirror = np.fft.fftshift(own, axes=0), np.fft.fftshift(mirror, axes=0)
    middle, start = cols // 2, part * columns
    stop = min(start + columns, cols // 2 + 1)
    for a, b in ((middle + start, min(middle + stop, cols)), (middle - stop + 1, min(middle - start + 1, middle))):
        if a >= b:
            continue
        left, right = max(0, a - reach), min(cols, b + reach)
        v = np.arange(left, right) - middle
        m = np.where(v >= 0, own[:, np.abs(v) - low], mirror[:, np.abs(v) - low])
        m = transforms.smoothed(m) if reach else m
        yield a, m[:, a - left : b - left]


def _column_pass(blocks: DataFrame, image: list[str], smooth: bool, columns: int, block: int, schema: str, made: Callable[..., list[dict]]) -> DataFrame:
    """Image columns and what made(first column, magnitudes, rows, cols) returns for each part of a spectrum, a dict for each row of schema."""
    if smooth and columns < REACH:
        raise ValueError(f"groups of {columns} columns are narrower than the kernel's reach")
    reach = REACH if smooth else 0
    lines = _row_pass(blocks, image, reach, columns, block).withColumn("block", F.lit(block))
    full = StructType.fromDDL(f"{_typed(blocks, image)}, {schema}")
    want = to_arrow_schema(full)

    def transform(table):
        import pyarrow as pa

        key = {c: table.column(c)[0].as_py() for c in image}
        rows, cols = table.column("rows")[0].as_py(), table.column("cols")[0].as_py()
        found = [key | r for x, m in _windows(table, columns, reach) for r in made(x, m, rows, cols)]
        return pa.Table.from_pylist(found, schema=want)

    return lines.groupBy(*image, "part").applyInArrow(transform, full)


def spectra(blocks: DataFrame, image: list[str], smooth: bool = False, log: bool = True, columns: int = COLUMNS, block: int = BLOCK) -> DataFrame:
    """Image columns, y, x (place of the first value in the spectrum, its zero frequency in the middle), h, w and pix (magnitudes, as log(1 + m) if asked for), in pieces of `block` rows."""

    def made(x, m, rows, cols):
        m = np.log1p(m) if log else m
        return [{"y": y, "x": x, "h": p.shape[0], "w": p.shape[1], "pix": p.ravel()} for y in range(0, rows, block) for p in (m[y : y + block],)]

    return _column_pass(blocks, image, smooth, columns, block, "y int, x int, h int, w int, pix array<double>", made)


def anomalies(blocks: DataFrame, image: list[str], factor: float = 3.0, smooth: bool = False, arms: tuple[int, int, int] | None = None, columns: int = COLUMNS, block: int = BLOCK) -> DataFrame:
    """Image columns, vertical, horizontal, corners (mean magnitudes over the arms and the corners) and anomaly: are both arms over `factor` times the corners. arms: as transforms.fourier_areas has them."""

    def made(x, m, rows, cols):
        out = []
        for kind, areas in transforms.fourier_areas(rows, cols, arms).items():
            parts = [m[r, max(c.start - x, 0) : max(c.stop - x, 0)] for r, c in areas]
            out.append({"kind": kind, "total": float(sum(p.sum() for p in parts)), "n": sum(p.size for p in parts)})
        return out

    sums = _column_pass(blocks, image, smooth, columns, block, "kind string, total double, n long", made)
    mean = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("total"))) / F.sum(F.when(F.col("kind") == kind, F.col("n")))
    out = sums.groupBy(*image).agg(*(mean(k).alias(k) for k in ("vertical", "horizontal", "corners")))
    over: Callable[[str], Column] = lambda arm: F.col(arm) > factor * F.col("corners")
    return out.withColumn("anomaly", over("vertical") & over("horizontal"))
