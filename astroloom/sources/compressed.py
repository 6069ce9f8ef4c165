"""Tile-compressed FITS images: Rice and gzip, whole or only the tiles under a window.

The image is a table of compressed tiles (ZIMAGE). Rice codes can't be entered in the middle, but tiles are independent: many are decoded
side by side, one pixel of each at a step, so that numpy does the work. Floating point images are whole numbers with a scale and a
zero for each tile, with the standard's dither where it is named; tiles that couldn't be scaled are gzipped or plain in columns of their own.

Defined results: blank pixels are NaN; a tile without any data is NaN; other codings raise ValueError."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fits
from .stores import Ranges

#: Bits that tell of a block's low bits, the number that stands for plain values, and the bits of those; by bytes of a pixel; fixed by the standard.
RICE = {1: (3, 6, 8), 2: (4, 14, 16), 4: (5, 25, 32)}
#: Tiles that are decoded side by side.
TOGETHER = 128
#: The dither's generator and the length of its sequence; fixed by the standard.
MULTIPLIER, MODULUS, RANDOMS = 16807, 2147483647, 10_000
#: The whole number that dither 2 keeps for an exact zero, and the usual one for blank.
ZERO, BLANK = -2147483646, -2147483648


def unrice(tiles: list[bytes], n: int, size: int = 4, block: int = 32) -> np.ndarray:
    """The n whole numbers of each tile (tiles x n)."""
    bits, plain, wide = RICE[size]
    start = np.cumsum([0, *(len(t) for t in tiles)])[:-1] * 8
    raw = np.frombuffer(b"".join(tiles) + bytes(8), np.uint8)
    ones = np.flatnonzero(np.unpackbits(raw))
    following = np.full(len(raw) * 8 + 1, len(raw) * 8, np.int32)  # the first set bit at or after each place
    following[ones] = ones
    following = np.minimum.accumulate(following[::-1])[::-1]
    bytes_ = raw.astype(np.int64)
    windows = bytes_[:-4] << 32 | bytes_[1:-3] << 24 | bytes_[2:-2] << 16 | bytes_[3:-1] << 8 | bytes_[4:]

    def field(at, k):
        at = np.minimum(at, 8 * len(windows) - 1)
        return windows[at >> 3] >> (40 - (at & 7) - k) & ((1 << k) - 1)

    first = field(start, 8 * size)
    at = start + 8 * size
    out = np.zeros((len(tiles), n), np.int64)
    for k in range(0, n, block):
        low = field(at, bits) - 1
        at = at + bits
        flat, full = low < 0, low == plain
        some, low = ~flat & ~full, np.where(flat | full, 0, low)
        for j in range(k, min(k + block, n)):
            one = following[np.minimum(at, len(following) - 1)].astype(np.int64)
            code = (one - at) << low | field(one + 1, low)
            out[:, j] = np.where(some, code, 0)
            step = np.where(some, one + 1 + low - at, 0)
            if full.any():
                out[full, j] = field(at, wide)[full]
                step = np.where(full, wide, step)
            at = at + step
    out = (out >> 1) ^ -(out & 1)
    out = np.cumsum(out, axis=1) + first[:, None]
    half = 1 << wide - 1
    return ((out + half) & (2 * half - 1)) - half if size > 1 else out & 255


def randoms() -> np.ndarray:
    out, seed = np.empty(RANDOMS), 1
    for k in range(RANDOMS):
        seed = seed * MULTIPLIER % MODULUS
        out[k] = seed / MODULUS
    return out


def dithers(tile: int, seed: int, n: int, table: np.ndarray) -> np.ndarray:
    """The n random numbers of a tile (numbered from 0)."""
    at = (tile + seed - 1) % RANDOMS
    parts, got = [], 0
    while got < n:
        own = table[int(table[at] * 500) :][: n - got]
        parts.append(own)
        got += len(own)
        at = (at + 1) % RANDOMS
    return np.concatenate(parts) if parts else np.zeros(0)


class Image:
    """A compressed image: head is its header, read(at, n) gives bytes of its data unit."""

    def __init__(self, head: dict, read: Callable[[int, int], bytes]):
        if head.get("ZNAXIS") != 2:
            raise ValueError("only images of two sides are read")
        self.head, self.read = head, read
        self.ny, self.nx = head["ZNAXIS2"], head["ZNAXIS1"]
        self.tx, self.ty = head.get("ZTILE1", self.nx), head.get("ZTILE2", 1)
        self.kind, self.bitpix = head["ZCMPTYPE"], head["ZBITPIX"]
        if self.kind not in ("RICE_1", "RICE_ONE", "GZIP_1", "GZIP_2"):
            raise ValueError(f"images compressed by {self.kind} aren't read")
        values = {head[f"ZNAME{k}"]: head[f"ZVAL{k}"] for k in range(1, 10) if f"ZNAME{k}" in head}
        self.block, self.size = values.get("BLOCKSIZE", 32), values.get("BYTEPIX", 4)
        self.dither = head.get("ZQUANTIZ", "NO_DITHER")
        self.heap = head.get("THEAP", head["NAXIS1"] * head["NAXIS2"])
        self.columns, at = {}, 0
        for k in range(1, head["TFIELDS"] + 1):
            form = head[f"TFORM{k}"].strip()
            digits = form[: len(form) - len(form.lstrip("0123456789"))]
            code, repeat = form[len(digits)], int(digits or 1)
            width = {"P": 8, "Q": 16, "D": 8, "E": 4, "J": 4, "K": 8, "I": 2, "B": 1, "L": 1, "A": 1}[code] * repeat
            self.columns[head[f"TTYPE{k}"].strip()] = (at, code)
            at += width
        self.decoded = 0
        self._table = randoms() if self.dither.startswith("SUBTRACTIVE") else None

    def _field(self, row: bytes, name: str):
        at, code = self.columns[name]
        kind, n = {"P": (">i4", 2), "Q": (">i8", 2), "D": (">f8", 1), "E": (">f4", 1), "J": (">i4", 1), "K": (">i8", 1), "I": (">i2", 1), "B": ("u1", 1)}[code]
        got = np.frombuffer(row, kind, n, at)
        return (int(got[0]), int(got[1])) if n == 2 else got[0].item()

    def _data(self, row: bytes, name: str) -> bytes:
        if name not in self.columns:
            return b""
        n, at = self._field(row, name)
        form = next(self.head[f"TFORM{k}"].strip() for k in range(1, self.head["TFIELDS"] + 1) if self.head[f"TTYPE{k}"].strip() == name)
        each = {"B": 1, "I": 2, "J": 4, "E": 4, "D": 8, "K": 8}[form.lstrip("0123456789")[1]]
        return self.read(self.heap + at, n * each) if n else b""

    def _unzipped(self, data: bytes, n: int, kind: str, shuffled: bool) -> np.ndarray:
        raw = zlib.decompress(data, 47)
        size = np.dtype(kind).itemsize
        if shuffled:
            raw = np.frombuffer(raw, np.uint8).reshape(size, n).T.tobytes()
        return np.frombuffer(raw, kind, n).astype(float if kind[1] == "f" else np.int64)

    def window(self, y0: int, y1: int, x0: int, x1: int) -> np.ndarray:
        """Pixels y0 to y1 and x0 to x1, in single precision; only the tiles under them are read and decoded."""
        y0, x0, y1, x1 = max(0, y0), max(0, x0), min(self.ny, y1), min(self.nx, x1)
        out = np.full((max(0, y1 - y0), max(0, x1 - x0)), np.nan, np.float32)
        if not out.size:
            return out
        across = -(-self.nx // self.tx)
        width = self.head["NAXIS1"]
        waiting: dict[int, list] = {}
        for i in range(y0 // self.ty, (y1 - 1) // self.ty + 1):
            a, b = x0 // self.tx, (x1 - 1) // self.tx + 1
            rows = self.read((i * across + a) * width, (b - a) * width)
            for j in range(a, b):
                row = rows[(j - a) * width : (j - a + 1) * width]
                shape = (min(self.ty, self.ny - i * self.ty), min(self.tx, self.nx - j * self.tx))
                waiting.setdefault(shape[0] * shape[1], []).append((i, j, shape, row))
        for n, own in waiting.items():
            for k in range(0, len(own), TOGETHER):
                part = own[k : k + TOGETHER]
                for (i, j, shape, _), v in zip(part, self._values(part, n, across), strict=True):
                    top, left = i * self.ty, j * self.tx
                    ya, yb, xa, xb = max(y0, top), min(y1, top + shape[0]), max(x0, left), min(x1, left + shape[1])
                    out[ya - y0 : yb - y0, xa - x0 : xb - x0] = v.reshape(shape)[ya - top : yb - top, xa - left : xb - left]
        return out

    def _values(self, tiles: list, n: int, across: int) -> list[np.ndarray]:
        """Pixel values of tiles of n pixels."""
        self.decoded += len(tiles)
        data = [self._data(row, "COMPRESSED_DATA") for *_, row in tiles]
        found: list = [None] * len(tiles)
        real = self.bitpix < 0
        lossless = real and "ZSCALE" not in self.columns and "ZSCALE" not in self.head
        if self.kind.startswith("RICE"):
            some = [k for k, d in enumerate(data) if d]
            if some:
                for k, v in zip(some, unrice([data[k] for k in some], n, self.size, self.block), strict=True):
                    found[k] = v
        else:
            kind = f">f{-self.bitpix // 8}" if lossless else f">i{max(4 if real else 1, abs(self.bitpix) // 8 if not real else 4)}"
            kind = "u1" if self.bitpix == 8 else kind
            for k, d in enumerate(data):
                found[k] = self._unzipped(d, n, kind if kind != "u1" else "|u1", self.kind == "GZIP_2") if d else None
        out = []
        for (i, j, _, row), v in zip(tiles, found, strict=True):
            if v is None:
                out.append(self._other(row, n))
                continue
            if lossless:
                out.append(v)
                continue
            blank = self._field(row, "ZBLANK") if "ZBLANK" in self.columns else self.head.get("ZBLANK", BLANK if real else self.head.get("BLANK"))
            number = lambda name, plain: self._field(row, name) if name in self.columns else self.head.get(name, plain)  # noqa: B023, E731
            scale, zero = (number("ZSCALE", 1.0), number("ZZERO", 0.0)) if real else (self.head.get("BSCALE", 1), self.head.get("BZERO", 0))
            if real and self._table is not None:
                value = (v - dithers(i * across + j, int(self.head.get("ZDITHER0", 1)), n, self._table) + 0.5) * scale + zero
                if self.dither.endswith("2"):
                    value = np.where(v == ZERO, 0.0, value)
            else:
                value = v * float(scale) + float(zero)
            out.append(np.where(v == blank, np.nan, value) if blank is not None else value)
        return out

    def _other(self, row: bytes, n: int) -> np.ndarray:
        """A tile that isn't in the main column."""
        kind = f">{'f' if self.bitpix < 0 else 'i'}{abs(self.bitpix) // 8}"
        if data := self._data(row, "GZIP_COMPRESSED_DATA"):
            return self._unzipped(data, n, kind, False)
        if data := self._data(row, "UNCOMPRESSED_DATA"):
            return np.frombuffer(data, kind, n).astype(float)
        return np.full(n, np.nan)


def opened(source: Ranges, extension: int) -> tuple[dict, int]:
    """Header of an extension and where its data start; no data are read on the way."""
    at = 0
    for k in range(extension + 1):
        raw = b""
        while True:
            if at + len(raw) + fits.RECORD > source.size:
                raise ValueError(f"the file has no extension {extension}")
            raw += source.read(at + len(raw), fits.RECORD)
            if any(raw[c : c + 8].rstrip() == b"END" for c in range(len(raw) - fits.RECORD, len(raw), fits.CARD)):
                break
        head = fits.cards(raw)
        if k == extension:
            return head, at + len(raw)
        at += len(raw) + -(-fits.data_size(head) // fits.RECORD) * fits.RECORD
    raise ValueError(extension)


def window(source: Ranges, extension: int, y0: int, y1: int, x0: int, x1: int) -> np.ndarray:
    """Pixels of a compressed or plain image, by byte ranges."""
    head, start = opened(source, extension)
    if head.get("ZIMAGE"):
        return Image(head, lambda at, n: source.read(start + at, n)).window(y0, y1, x0, x1)
    y0, x0, y1, x1 = max(0, y0), max(0, x0), min(head.get("NAXIS2", 0), y1), min(head.get("NAXIS1", 0), x1)
    if y0 >= y1 or x0 >= x1:
        return np.zeros((max(0, y1 - y0), max(0, x1 - x0)), np.float32)
    line = abs(head["BITPIX"]) // 8 * head["NAXIS1"]
    rows = fits.pixels(head | {"NAXIS2": y1 - y0}, source.read(start + y0 * line, (y1 - y0) * line))
    return rows[:, x0:x1]


def cutouts(objects: DataFrame, key: list[str], size: int, extension: int | str = "auto") -> DataFrame:
    """key and pix (size x size, zeros outside the image) around x, y in the image at path. objects: key, path, x, y.

    Files are read by ranges: of a compressed image only the tiles under a cutout are decoded. Objects of one file are brought together, so that a task opens it once; a file with many is several groups."""
    kept = objects.select(*dict.fromkeys([*key, "path", "x", "y"]))
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*key).schema.fields)

    def rows(batches):
        import pyarrow as pa

        held: tuple[str, Ranges] | None = None
        for batch in batches:
            out = []
            for path, x, y in zip(*(batch.column(c).to_pylist() for c in ("path", "x", "y")), strict=True):
                if held is None or held[0] != path:
                    if held:
                        held[1].close()
                    held = (path, Ranges(path))
                top, left = (int(np.floor(v + 0.5)) - size // 2 for v in (y, x))
                got = window(held[1], fits.extension_of(path, extension), top, top + size, left, left + size)
                image = np.zeros((size, size), np.float32)
                image[max(0, -top) : max(0, -top) + got.shape[0], max(0, -left) : max(0, -left) + got.shape[1]] = got
                out.append(image.ravel())
            edges = pa.array(np.arange(len(out) + 1, dtype=np.int32) * size * size)
            pix = pa.ListArray.from_arrays(edges, pa.array(np.concatenate(out) if out else np.zeros(0, np.float32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in key), pix], names=[*key, "pix"])

    near = F.floor(F.col("y") / (8 * size))
    return kept.repartition("path", near).sortWithinPartitions("path", "y").mapInArrow(rows, f"{typed}, pix array<float>")
