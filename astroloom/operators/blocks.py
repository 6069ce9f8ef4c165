"""Anomalies and background of whole tiles, from their blocks.

An image is rows (image columns, by, bx, h, w, pix) as operators.images has them: a tile of 10 000 x 10 000 pixels never stands in a row or a
task. Flat patches are labelled within each block; the patches at a block's rim meet those of the blocks beside it by image, where only rims
come together, and patches within a block that are too small never leave it. Background levels come from mesh squares, of which a block holds
whole ones, so no pixel moves; the grid of levels, one number for each square, goes back to the blocks.

Defined results: missing and infinite pixels are never flat and are left out of a background; a block that is absent joins nothing and has no
mesh squares; a null or empty pix is an absent block; an image whose blocks are all absent has no rows; an empty table gives no rows.
Blocks have an even side that is a multiple of the mesh's, except at the image's end; else ValueError.
What meets in one task for an image: rims, 4 x block / 2 numbers for each block and kind, and mesh squares."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions import transforms
from .images import BLOCK

KINDS = ("diagonal", "horizontal", "vertical")
SIDES = ("top", "bottom", "left", "right")


def each_block(blocks: DataFrame, image: list[str], extra: list[str], schema: str, made: Callable[..., list[dict]]) -> DataFrame:
    """Image columns, by, bx and what made(pixels, by, bx, *extra) returns, a dict for each row of schema. Pixels pass as flat Arrow arrays."""
    kept = blocks.select(*image, "by", "bx", *extra, "h", "w", "pix").where(F.size("pix") > 0)
    keys = [*image, "by", "bx"]
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*keys).schema.fields)
    out_schema = StructType.fromDDL(f"{typed}, {schema}")
    want = to_arrow_schema(out_schema)

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                pix = batch.column("pix").slice(k, 1).flatten().to_numpy(zero_copy_only=False)
                key = {c: batch.column(c)[k].as_py() for c in keys}
                found = made(pix.reshape(batch.column("h")[k].as_py(), -1), key["by"], key["bx"], *(batch.column(c)[k].as_py() for c in extra))
                if found:
                    yield pa.RecordBatch.from_pylist([key | r for r in found], schema=want)

    return kept.mapInArrow(rows, out_schema)


def _labels(pixels: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of detail: the labels of flat patches, and which of them are at the rim, in order."""
    _, across, down, diagonal = transforms.haar(pixels)
    out = []
    for detail in (diagonal, across, down):
        label = transforms.components(np.abs(detail) <= threshold)
        rim = np.unique(np.concatenate([label[0], label[-1], label[:, 0], label[:, -1]]))
        out.append((label, rim[rim > 0]))
    return out


def _patches(blocks: DataFrame, image: list[str], threshold: float, least: int, block: int) -> DataFrame:
    """For each block and kind: inner patches of `least` or more, rim patches (place of the first coefficient, size), and the rim's numbers by side; 0 is no patch."""
    half = block // 2

    def made(pixels, by, bx):
        out = []
        for kind, (label, rim) in zip(KINDS, _labels(pixels, threshold), strict=True):
            names, first, size = np.unique(label.ravel(), return_index=True, return_counts=True)
            place = ((by * half + first // label.shape[1]).astype(np.int64) << 32) | (bx * half + first % label.shape[1])
            at_rim, number = np.isin(names, rim), np.zeros(label.max() + 1, np.int64)
            number[rim] = np.arange(1, len(rim) + 1)
            inner = ~at_rim & (names > 0) & (size >= least)
            if inner.any() or len(rim):
                sides = dict(zip(SIDES, (number[x].tolist() for x in (label[0], label[-1], label[:, 0], label[:, -1])), strict=True))
                out.append({"kind": kind, "inner_first": place[inner].tolist(), "inner_size": size[inner].tolist(), "first": place[at_rim].tolist(), "size": size[at_rim].tolist()} | sides)
        return out

    longs = ", ".join(f"{c} array<bigint>" for c in ("inner_first", "inner_size", "first", "size", *SIDES))
    return each_block(blocks, image, [], f"kind string, {longs}", made)


def _joined(patches: DataFrame, image: list[str]) -> DataFrame:
    """For each rim patch (image, kind, by, bx, number from 1) the first coefficient and the size of the whole patch it belongs to."""
    rims = patches.where(F.size("first") > 0).select(*image, "kind", "by", "bx", "first", "size", *SIDES)
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rims.select(*image).schema.fields)

    def join(table):
        import pyarrow as pa

        rows = table.select(["by", "bx", "first", "size", *SIDES]).to_pylist()
        start = np.cumsum([0, *(len(r["first"]) for r in rows)])
        at = {(r["by"], r["bx"]): k for k, r in enumerate(rows)}
        links = []
        for k, r in enumerate(rows):
            for side, other, step in (("right", "left", (0, 1)), ("bottom", "top", (1, 0))):
                j = at.get((r["by"] + step[0], r["bx"] + step[1]))
                if j is not None:
                    n = min(len(r[side]), len(rows[j][other]))
                    a, b = np.array(r[side][:n]), np.array(rows[j][other][:n])
                    both = (a > 0) & (b > 0)
                    links.append(np.stack([start[k] + a[both] - 1, start[j] + b[both] - 1]))
        a, b = np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64)
        root = transforms.united(int(start[-1]), a, b)
        size, first = np.zeros(int(start[-1]), np.int64), np.full(int(start[-1]), np.iinfo(np.int64).max)
        np.add.at(size, root, np.concatenate([r["size"] for r in rows]))
        np.minimum.at(first, root, np.concatenate([r["first"] for r in rows]))
        own = np.repeat(np.arange(len(rows)), np.diff(start))
        key = {c: table.column(c).take(pa.array(own)) for c in (*image, "kind", "by", "bx")}
        return pa.table(key | {"number": pa.array(np.arange(int(start[-1])) - start[own] + 1), "first": pa.array(first[root]), "size": pa.array(size[root])})

    return rims.groupBy(*image, "kind").applyInArrow(join, f"{typed}, kind string, by int, bx int, number long, first long, size long")


def _checked(block: int, mesh: int = 2) -> None:
    if block % 2 or block % mesh:
        raise ValueError(f"blocks of {block} pixels hold no whole squares of {mesh}")


def flat_patches(blocks: DataFrame, image: list[str], threshold: float = 0.0025, least: int = 50, block: int = BLOCK) -> DataFrame:
    """Image columns, kind, y, x (the first coefficient in reading order) and size of each flat patch of `least` coefficients or more."""
    _checked(block)
    patches = _patches(blocks, image, threshold, least, block)
    inner = patches.select(*image, "kind", F.explode(F.arrays_zip("inner_first", "inner_size")).alias("p")).select(*image, "kind", F.col("p.inner_first").alias("first"), F.col("p.inner_size").alias("size"))
    rim = _joined(patches, image).where(F.col("size") >= least).select(*image, "kind", "first", "size").distinct()
    both = inner.unionByName(rim)
    return both.select(*image, "kind", F.shiftright("first", 32).cast("int").alias("y"), F.col("first").bitwiseAND(0xFFFFFFFF).cast("int").alias("x"), "size")


def haar_anomalies(blocks: DataFrame, image: list[str], threshold: float = 0.0025, least: int = 50, block: int = BLOCK) -> DataFrame:
    """Image columns, diagonal, horizontal, vertical: has that detail a flat patch; images without one have no row."""
    found = flat_patches(blocks, image, threshold, least, block)
    return found.groupBy(*image).agg(*(F.bool_or(F.col("kind") == k).alias(k) for k in KINDS))


def flat_masks(blocks: DataFrame, image: list[str], threshold: float = 0.0025, least: int = 50, dilate: int = 0, block: int = BLOCK) -> DataFrame:
    """Image columns, by, bx, h, w and mask (pixels under flat patches, row by row) of each block; grown by `dilate` steps across blocks."""
    _checked(block)
    big = _joined(_patches(blocks, image, threshold, least, block), image).where(F.col("size") >= least)
    named = big.groupBy(*image, "by", "bx").agg(F.collect_set(F.struct("kind", "number")).alias("big"))  # patches at one block's rim
    none = F.array().cast("array<struct<kind:string,number:bigint>>")
    known = blocks.select(*image, "by", "bx", "h", "w", "pix").join(named, [*image, "by", "bx"], "left").withColumn("big", F.coalesce("big", none))

    def made(pixels, by, bx, chosen):
        mask = np.zeros([-(-n // 2) for n in pixels.shape], bool)
        for kind, (label, rim) in zip(KINDS, _labels(pixels, threshold), strict=True):
            keep = np.bincount(label.ravel()) >= least
            keep[0] = False
            keep[rim] = False
            keep[rim[[x["number"] - 1 for x in chosen if x["kind"] == kind]]] = True
            mask |= keep[label]
        own = np.kron(mask, np.ones((2, 2), bool))[: pixels.shape[0], : pixels.shape[1]]
        return [{"h": pixels.shape[0], "w": pixels.shape[1], "mask": own.ravel().tolist()}]

    out = each_block(known, image, ["big"], "h int, w int, mask array<boolean>", made)
    return grown(out, image, dilate) if dilate else out


def grown(masks: DataFrame, image: list[str], times: int) -> DataFrame:
    """Masks of blocks grown by the four neighbours, `times` over, at most a block's side. Each block sends its neighbours only the strip that reaches them, and nothing where that is unset."""
    keys = [*image, "by", "bx"]
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in masks.select(*image).schema.fields)

    strip = StructType.fromDDL(f"{typed}, by int, bx int, dy int, dx int, h int, w int, mask array<boolean>")
    want = to_arrow_schema(strip)

    def strips(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                h, w = r["h"], r["w"]
                mask = np.array(r["mask"], bool).reshape(h, w)
                key = {c: r[c] for c in image}
                rows.append(key | {"by": r["by"], "bx": r["bx"], "dy": 0, "dx": 0, "h": h, "w": w, "mask": r["mask"]})
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        cut = lambda d, n: slice(0, min(times, n)) if d < 0 else slice(max(0, n - times), n) if d > 0 else slice(0, n)
                        own = mask[cut(dy, h), cut(dx, w)]
                        if (dy or dx) and own.any():
                            rows.append(key | {"by": r["by"] + dy, "bx": r["bx"] + dx, "dy": -dy, "dx": -dx, "h": own.shape[0], "w": own.shape[1], "mask": own.ravel().tolist()})
            yield pa.RecordBatch.from_pylist(rows, schema=want)

    def grow(table):
        import pyarrow as pa

        rows = table.to_pylist()
        own = [r for r in rows if not r["dy"] and not r["dx"]]
        if not own:  # a strip for a block that is absent
            return table.slice(0, 0).select([*keys, "h", "w", "mask"])
        h, w = own[0]["h"], own[0]["w"]
        pad = np.zeros((h + 2 * times, w + 2 * times), bool)
        for r in rows:
            y = times if r["dy"] == 0 else times - r["h"] if r["dy"] < 0 else times + h
            x = times if r["dx"] == 0 else times - r["w"] if r["dx"] < 0 else times + w
            pad[y : y + r["h"], x : x + r["w"]] |= np.array(r["mask"], bool).reshape(r["h"], r["w"])
        out = transforms.dilated(pad, times)[times : times + h, times : times + w]
        key = {c: table.column(c).slice(0, 1) for c in keys}
        return pa.table(key | {"h": pa.array([h], pa.int32()), "w": pa.array([w], pa.int32()), "mask": pa.array([out.ravel().tolist()], pa.list_(pa.bool_()))})

    whole = f"{typed}, by int, bx int, h int, w int, mask array<boolean>"
    sent = masks.select(*keys, "h", "w", "mask").mapInArrow(strips, strip)
    return sent.groupBy(*keys).applyInArrow(grow, whole)


def mesh_squares(blocks: DataFrame, image: list[str], mesh: int = 128, sigma: float = 3.0, rounds: int = 10, block: int = BLOCK) -> DataFrame:
    """Image columns, my, mx, level and rms of each mesh square after clipping; null where no pixel has a value."""
    _checked(block, mesh)
    side = block // mesh
    number = lambda v: None if np.isnan(v) else float(v)

    def made(pixels, by, bx):
        level, rms = transforms.mesh_squares(pixels, mesh, sigma, rounds)
        return [{"my": by * side + i, "mx": bx * side + j, "level": number(level[i, j]), "rms": number(rms[i, j])} for i in range(level.shape[0]) for j in range(level.shape[1])]

    return each_block(blocks, image, [], "my int, mx int, level double, rms double", made).drop("by", "bx")


def smooth_squares(squares: DataFrame, image: list[str]) -> DataFrame:
    """Level and rms of each square become the medians of the 3 x 3 squares around it: a square is sent to its neighbours, and those that exist count."""
    near = F.array(*(F.struct(F.lit(i).alias("dy"), F.lit(j).alias("dx")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    sent = squares.select(*image, "my", "mx", "level", "rms", F.explode(near).alias("n"))
    sent = sent.select(*image, (F.col("my") + F.col("n.dy")).alias("my"), (F.col("mx") + F.col("n.dx")).alias("mx"), "level", "rms", ((F.col("n.dy") == 0) & (F.col("n.dx") == 0)).alias("own"))
    out = sent.groupBy(*image, "my", "mx").agg(F.median("level").alias("level"), F.median("rms").alias("rms"), F.bool_or("own").alias("own"))
    return out.where("own").drop("own")


def background_rms(blocks: DataFrame, image: list[str], mesh: int = 128, sigma: float = 3.0, rounds: int = 10, block: int = BLOCK) -> DataFrame:
    """Image columns and rms: the median over mesh squares of the scatter that is left after clipping."""
    squares = smooth_squares(mesh_squares(blocks, image, mesh, sigma, rounds, block), image)
    return squares.groupBy(*image).agg(F.median("rms").alias("rms"))


def _grids(blocks: DataFrame, image: list[str], mesh: int, sigma: float, rounds: int, block: int) -> DataFrame:
    """Image columns, rms, and the levels of all its mesh squares as arrays my, mx, level."""
    squares = smooth_squares(mesh_squares(blocks, image, mesh, sigma, rounds, block), image)
    return squares.groupBy(*image).agg(F.median("rms").alias("rms"), F.collect_list(F.struct("my", "mx", "level")).alias("grid"))


def _level(grid: list[dict], mesh: int, block: int, by: int, bx: int, shape: tuple) -> np.ndarray:
    """The background under one block."""
    level = np.full((1 + max(g["my"] for g in grid), 1 + max(g["mx"] for g in grid)), np.nan)
    for g in grid:
        level[g["my"], g["mx"]] = np.nan if g["level"] is None else g["level"]
    if not np.isfinite(level).any():
        return np.zeros(shape)
    return transforms.spline(level, mesh, by * block + np.arange(shape[0]), bx * block + np.arange(shape[1]))


def background_removed(blocks: DataFrame, image: list[str], seed: Column, mesh: int = 128, least: float = -0.1, sigma: float = 3.0, rounds: int = 10, block: int = BLOCK) -> DataFrame:
    """Blocks less the background, a bicubic spline through the mesh squares; missing pixels and those under `least` become noise of the background's scatter. seed: a whole number for each image."""
    grids = _grids(blocks, image, mesh, sigma, rounds, block)
    known = blocks.withColumn("_seed", seed.cast("long")).join(grids, image)

    def made(pixels, by, bx, number, rms, grid):
        out = pixels.astype(float) - _level(grid, mesh, block, by, bx, pixels.shape)
        mask = np.isnan(pixels) | (out < least)
        noise = np.random.default_rng([abs(number or 0), by, bx]).normal(0, rms or 0.0, pixels.shape)
        return [{"h": pixels.shape[0], "w": pixels.shape[1], "pix": np.where(mask, noise, out).ravel().tolist()}]

    return each_block(known, image, ["_seed", "rms", "grid"], "h int, w int, pix array<double>", made)


def replaced(blocks: DataFrame, image: list[str], seed: Column, threshold: float = 0.0025, least: int = 50, dilate: int = 1, mesh: int = 128, block: int = BLOCK) -> DataFrame:
    """Blocks with noise of the background's scatter in flat patches. seed: a whole number for each image, so that a task that runs again makes the same noise."""
    masks = flat_masks(blocks, image, threshold, least, dilate, block).select(*image, "by", "bx", "mask")
    known = blocks.withColumn("_seed", seed.cast("long")).join(masks, [*image, "by", "bx"]).join(background_rms(blocks, image, mesh, block=block), image)

    def made(pixels, by, bx, number, rms, mask):
        noise = np.random.default_rng([abs(number or 0), by, bx]).normal(0, rms or 0.0, pixels.shape)
        return [{"h": pixels.shape[0], "w": pixels.shape[1], "pix": np.where(np.array(mask).reshape(pixels.shape), noise, pixels).ravel().tolist()}]

    return each_block(known, image, ["_seed", "rms", "mask"], "h int, w int, pix array<float>", made)
