"""Compressed FITS images against a plain bit-by-bit coder that writes them here."""

from __future__ import annotations

import gzip
import struct

import numpy as np
import pytest

from astroloom.sources import compressed, fits
from astroloom.sources.stores import Ranges

RNG = np.random.default_rng(2)
NY, NX = 37, 50


def rice(values: np.ndarray, size: int = 4, block: int = 32) -> bytes:
    """The standard's coder, a string of bits at a time."""
    bits, plain, wide = compressed.RICE[size]
    v = [int(x) for x in values.ravel()]
    text = format(v[0] & (1 << wide) - 1, f"0{wide}b")
    before, codes = v[0], []
    half = 1 << wide - 1
    for x in v:
        d = ((x - before + half) & (2 * half - 1)) - half
        codes.append(2 * d if d >= 0 else -2 * d - 1)
        before = x
    for k in range(0, len(codes), block):
        own = codes[k : k + block]
        if not any(own):
            text += format(0, f"0{bits}b")
            continue
        cost = {f: sum((c >> f) + 1 + f for c in own) for f in range(plain)}
        f = min(cost, key=cost.get)
        if cost[f] >= wide * len(own):
            text += format(plain + 1, f"0{bits}b") + "".join(format(c, f"0{wide}b") for c in own)
        else:
            text += format(f + 1, f"0{bits}b") + "".join("0" * (c >> f) + "1" + (format(c & (1 << f) - 1, f"0{f}b") if f else "") for c in own)
    text += "0" * (-len(text) % 8)
    return int(text, 2).to_bytes(len(text) // 8, "big")


def file_of(cards: list, columns: dict, rows: list[dict]) -> bytes:
    """A file whose first extension is a compressed image. columns: name -> form; rows: bytes for P columns, numbers for others."""
    table, heap = b"", b""
    for r in rows:
        for name, form in columns.items():
            if form[1] == "P":
                table += struct.pack(">ii", len(r[name]), len(heap))
                heap += r[name]
            else:
                table += struct.pack({"D": ">d", "J": ">i"}[form[1]], r[name])
    width = len(table) // len(rows)
    head = [("XTENSION", "'BINTABLE'"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", width), ("NAXIS2", len(rows)), ("PCOUNT", len(heap)), ("GCOUNT", 1), ("TFIELDS", len(columns))]
    head += [x for k, (n, f) in enumerate(columns.items()) for x in ((f"TTYPE{k + 1}", f"'{n}'"), (f"TFORM{k + 1}", f"'{f}'"))] + [("ZIMAGE", "T"), *cards]
    text = "".join(f"{k:<8}= {v:>20}".ljust(80) for k, v in head) + "END".ljust(80)
    first = "".join(f"{k:<8}= {v:>20}".ljust(80) for k, v in [("SIMPLE", "T"), ("BITPIX", 8), ("NAXIS", 0)]) + "END".ljust(80)
    pad = lambda b, by: b + by * (-len(b) % 2880)
    return pad(first.encode(), b" ") + pad(text.encode(), b" ") + pad(table + heap, b"\0")


def tiles(image: np.ndarray, ty: int, tx: int) -> list[np.ndarray]:
    return [image[y : y + ty, x : x + tx] for y in range(0, image.shape[0], ty) for x in range(0, image.shape[1], tx)]


def sides(kind: str, bitpix: int, ty: int, tx: int, shape=(NY, NX)) -> list:
    return [("ZCMPTYPE", f"'{kind}'"), ("ZBITPIX", bitpix), ("ZNAXIS", 2), ("ZNAXIS1", shape[1]), ("ZNAXIS2", shape[0]), ("ZTILE1", tx), ("ZTILE2", ty)]


@pytest.mark.parametrize(("size", "low", "high"), [(4, -(2**31), 2**31), (4, -50, 50), (4, 7, 8), (2, -(2**15), 2**15), (2, 0, 3), (1, 0, 256)])
def test_rice_codes(size, low, high):
    for n in (1, 31, 32, 33, 200):
        own = [RNG.integers(low, high, n) for _ in range(5)] + [np.arange(n) % max(1, min(100, high - low)) + low]
        assert np.array_equal(compressed.unrice([rice(v, size) for v in own], n, size), np.stack(own))


@pytest.mark.parametrize(("ty", "tx"), [(1, NX), (8, 16)])
@pytest.mark.parametrize("dither", ["NO_DITHER", "SUBTRACTIVE_DITHER_1", "SUBTRACTIVE_DITHER_2"])
def test_scaled_floats(ty, tx, dither):
    number = RNG.integers(-3000, 3000, (NY, NX))
    number[3, 4] = compressed.BLANK
    if dither.endswith("2"):
        number[5, 6] = compressed.ZERO
    rows, want = [], np.zeros((NY, NX))
    parts, seed = tiles(number, ty, tx), 77
    table = compressed.randoms()
    decoded = []
    for k, own in enumerate(parts):
        scale, zero = 0.01 + k / 1000, 5.0 - k
        rows.append({"COMPRESSED_DATA": rice(own), "ZSCALE": scale, "ZZERO": zero})
        shift = 0.0
        if dither != "NO_DITHER":
            at = (k + seed - 1) % 10000
            first = int(table[at] * 500)
            shift = 0.5 - table[first : first + own.size].reshape(own.shape)
        v = (own + shift) * scale + zero
        v = np.where(own == compressed.ZERO, 0.0, v) if dither.endswith("2") else v
        decoded.append(np.where(own == compressed.BLANK, np.nan, v))
    values = iter(decoded)
    for y in range(0, NY, ty):
        for x in range(0, NX, tx):
            own = next(values)
            want[y : y + own.shape[0], x : x + own.shape[1]] = own
    raw = file_of([*sides("RICE_1", -32, ty, tx), ("ZQUANTIZ", f"'{dither}'"), ("ZDITHER0", seed), ("ZBLANK", compressed.BLANK)], {"COMPRESSED_DATA": "1PB(999)", "ZSCALE": "1D", "ZZERO": "1D"}, rows)
    assert np.array_equal(fits.pixels(*fits.unit(raw, 1)), want.astype(np.float32), equal_nan=True)


@pytest.mark.parametrize("kind", ["GZIP_1", "GZIP_2"])
def test_gzip_and_tiles_apart(kind):
    image = RNG.normal(0, 1, (NY, NX)).astype(">f4")
    rows = []
    for k, own in enumerate(tiles(image, 10, 50)):
        raw = own.tobytes()
        raw = np.frombuffer(raw, np.uint8).reshape(-1, 4).T.tobytes() if kind == "GZIP_2" else raw
        rows.append({"COMPRESSED_DATA": gzip.compress(raw) if k else b"", "GZIP_COMPRESSED_DATA": b"" if k else gzip.compress(own.tobytes())})
    raw = file_of(sides(kind, -32, 10, 50), {"COMPRESSED_DATA": "1PB(9)", "GZIP_COMPRESSED_DATA": "1PB(9)"}, rows)
    assert np.array_equal(fits.pixels(*fits.unit(raw, 1)), image)
    with pytest.raises(ValueError):
        fits.pixels(*fits.unit(raw.replace(f"'{kind}'".encode(), b"'PLIO_1'"), 1))


def test_whole_numbers(spark, tmp_path):
    image = RNG.integers(-500, 500, (NY, NX))
    cards = [*sides("RICE_1", 16, 1, NX), ("ZNAME1", "'BLOCKSIZE'"), ("ZVAL1", 16), ("ZNAME2", "'BYTEPIX'"), ("ZVAL2", 2), ("BZERO", 32768), ("BSCALE", 2)]
    raw = file_of(cards, {"COMPRESSED_DATA": "1PB(99)"}, [{"COMPRESSED_DATA": rice(r, 2, 16)} for r in image])
    (tmp_path / "calexp-1.fits").write_bytes(raw)
    rows = fits.image_blocks(spark, str(tmp_path), block=20).collect()
    got = np.zeros((NY, NX))
    for r in rows:
        got[r["by"] * 20 : r["by"] * 20 + r["h"], r["bx"] * 20 : r["bx"] * 20 + r["w"]] = np.array(r["pix"]).reshape(r["h"], r["w"])
    assert np.array_equal(got, image * 2.0 + 32768)


def test_a_cutout_decodes_only_the_tiles_under_it(spark, tmp_path):
    number = RNG.integers(-3000, 3000, (200, 300))
    rows = [{"COMPRESSED_DATA": rice(own), "ZSCALE": 0.5, "ZZERO": 1.0} for own in tiles(number, 16, 32)]
    raw = file_of(sides("RICE_1", -32, 16, 32, (200, 300)), {"COMPRESSED_DATA": "1PB(999)", "ZSCALE": "1D", "ZZERO": "1D"}, rows)
    path = tmp_path / "calexp-9.fits"
    path.write_bytes(raw)
    plain = tmp_path / "plain.fits"
    plain.write_bytes(fits.encoded((number * 0.5 + 1).astype(np.float32)))
    source = Ranges(str(path))
    head, start = compressed.opened(source, 1)
    image = compressed.Image(head, lambda at, n: source.read(start + at, n))
    source.bytes_read = 0
    assert np.array_equal(image.window(30, 50, 60, 70), number[30:50, 60:70] * 0.5 + 1)
    assert image.decoded == 3 * 2 and source.bytes_read < len(raw) / 10
    where = [(k, str(p), x, y) for p in (path, plain) for k, (x, y) in enumerate([(60.4, 33.5), (0.0, 0.0), (299.0, 199.0), (150.0, 100.0)])]
    got = compressed.cutouts(spark.createDataFrame(where, "k int, path string, x double, y double"), ["k", "path"], 10).collect()
    assert len(got) == 8
    full = np.pad(number * 0.5 + 1, 20)
    for r in got:
        x, y = next((w[2], w[3]) for w in where if w[0] == r["k"])
        top, left = int(np.floor(y + 0.5)) - 5, int(np.floor(x + 0.5)) - 5
        assert np.array_equal(np.array(r["pix"]).reshape(10, 10), full[top + 20 : top + 30, left + 20 : left + 30])
