"""FITS files: images as blocks of pixels, binary and text tables as rows.

Files come in through Spark's binaryFile reader, so any store will do; a task
parses one file at a time with numpy. An image leaves its task as blocks, never
as one row, in the form that operators.images reads. Only the standard's own
structures are read: 2880-byte records, header cards of 80 bytes, big-endian
numbers, BSCALE and BZERO. Compressed images: sources.compressed.

Defined results: BLANK pixels of whole-number images and empty table fields are
missing (NaN in pixels, null in tables); an extension that a file lacks raises;
an image without pixels gives no blocks; a table without rows gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.images import BLOCK

RECORD, CARD = 2880, 80
#: Number of bytes and numpy type of a table's field codes, and of images; fixed by the standard.
FIELDS = {"L": "S1", "B": "u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8"}
PIXELS = {8: "u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}


def _value(text: str):
    """The value of a header card."""
    text = text.strip()
    if text.startswith("'"):
        end, k = [], 1
        while k < len(text):
            if text[k] == "'":
                if text[k + 1 : k + 2] != "'":
                    break
                k += 1
            end.append(text[k])
            k += 1
        return "".join(end).rstrip()
    text = text.split("/")[0].strip()
    if text in ("T", "F"):
        return text == "T"
    for kind in (int, float):
        try:
            return kind(text.replace("D", "E") if kind is float else text)
        except ValueError:
            pass
    return text or None


def cards(raw: bytes) -> dict:
    """Names and values of a header's cards, up to END."""
    head, text = {}, raw.decode("ascii", "replace")
    for k in range(0, len(text), CARD):
        card = text[k : k + CARD]
        if card[:8].rstrip() == "END":
            break
        if card[8:10] == "= ":
            head[card[:8].rstrip()] = _value(card[10:])
    return head


def data_size(head: dict) -> int:
    """Bytes of a unit's data, the heap of a table included."""
    sides = [head.get(f"NAXIS{k}", 0) for k in range(1, head.get("NAXIS", 0) + 1)]
    pixels = int(np.prod(sides, dtype=np.int64)) if sides else 0
    return abs(head.get("BITPIX", 8)) // 8 * head.get("GCOUNT", 1) * (head.get("PCOUNT", 0) + pixels)


def units(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header and data of each unit of a file."""
    at = 0
    while at + RECORD <= len(content):
        start, done = at, False
        while not done:
            record = content[at : at + RECORD]
            if len(record) < RECORD:
                raise ValueError("the header has no END")
            at += RECORD
            done = any(record[k : k + 8].rstrip() == b"END" for k in range(0, RECORD, CARD))
        head = cards(content[start:at])
        size = data_size(head)
        yield head, content[at : at + size]
        at += -(-size // RECORD) * RECORD


def unit(content: bytes, extension: int) -> tuple[dict, bytes]:
    for k, found in enumerate(units(content)):
        if k == extension:
            return found
    raise ValueError(f"the file has no extension {extension}")


def extension_of(path: str, extension: int | str) -> int:
    """'auto' is the first extension where the path, its folders included, speaks of calibrated exposures or survey z tiles, else the primary unit."""
    if extension != "auto":
        return int(extension)
    return int("calexp" in path or "WISHES" in path)


def pixels(head: dict, data: bytes) -> np.ndarray:
    """A two-dimensional image in single precision."""
    if head.get("ZIMAGE"):
        from .compressed import Image

        return Image(head, lambda at, n: data[at : at + n]).window(0, head["ZNAXIS2"], 0, head["ZNAXIS1"])
    if head.get("NAXIS", 0) != 2:
        return np.zeros((0, 0), np.float32)
    raw = np.frombuffer(data, PIXELS[head["BITPIX"]]).reshape(head["NAXIS2"], head["NAXIS1"])
    scale, zero = head.get("BSCALE", 1), head.get("BZERO", 0)
    out = raw.astype(np.float32) if (scale, zero) == (1, 0) else (raw * float(scale) + float(zero)).astype(np.float32)
    if head["BITPIX"] > 0 and head.get("BLANK") is not None:
        out[raw == head["BLANK"]] = np.nan
    return out


def _files(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")


def image_blocks(spark: SparkSession, path: str | list[str], extension: int | str = "auto", block: int = BLOCK, glob: str = "*.fits") -> DataFrame:
    """path, by, bx, h, w, pix: blocks of the images."""

    def rows(batches):
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                image = pixels(*unit(content, extension_of(name, extension)))
                for y in range(0, image.shape[0], block):
                    parts = [image[y : y + block, x : x + block] for x in range(0, image.shape[1], block)]
                    yield pd.DataFrame({"path": name, "by": y // block, "bx": range(len(parts)), "h": parts[0].shape[0], "w": [p.shape[1] for p in parts], "pix": [p.ravel() for p in parts]})

    return _files(spark, path, glob).mapInPandas(rows, "path string, by int, bx int, h int, w int, pix array<float>")


def headers(spark: SparkSession, path: str | list[str], extension: int | str = "auto", glob: str = "*.fits") -> DataFrame:
    """path and cards (name -> value as text)."""

    def rows(batches):
        for pdf in batches:
            cards = [{k: str(v) for k, v in unit(c, extension_of(p, extension))[0].items()} for p, c in zip(pdf["path"], pdf["content"], strict=True)]
            yield pd.DataFrame({"path": pdf["path"], "cards": cards})

    return _files(spark, path, glob).mapInPandas(rows, "path string, cards map<string,string>")


def scale_of(cards) -> dict:
    """Arc seconds a pixel and sides of an image, from its cards, as Columns."""
    card = lambda n, kind: F.try_element_at(cards, F.lit(n)).try_cast(kind)
    return {"scale": F.abs(card("CD1_1", "double")) * 3600, "nx": card("NAXIS1", "int"), "ny": card("NAXIS2", "int")}


def _columns(head: dict, data: bytes) -> dict[str, list | np.ndarray]:
    """All columns of a table. Names that differ by case only get the place of the field behind them."""
    n, width = head["NAXIS2"], head["NAXIS1"]
    raw = np.frombuffer(data, np.uint8)[: n * width].reshape(n, width)
    out, at, seen = {}, 0, set()
    for k in range(1, head["TFIELDS"] + 1):
        form, name = head[f"TFORM{k}"].strip(), str(head.get(f"TTYPE{k}", f"col{k}"))
        name = f"{name}_{k}" if name.lower() in seen else name
        seen.add(name.lower())
        if head["XTENSION"] == "TABLE":  # text: letter, width, decimals
            at = head[f"TBCOL{k}"] - 1
            size = int(form[1:].split(".")[0])
            text = [bytes(r).decode("utf-8", "replace").strip() for r in raw[:, at : at + size]]
            null = str(head.get(f"TNULL{k}", "")).strip()
            kind = {"A": str, "I": int}.get(form[0], lambda v: float(v.replace("D", "E")))
            out[name] = [None if v in ("", null) else kind(v) for v in text]
            continue
        digits = form.rstrip("".join(FIELDS) + "AXCMPQ")
        repeat, code = int(digits or 1), form[len(digits) : len(digits) + 1]
        if code == "A":
            out[name] = [bytes(r).split(b"\0")[0].decode("utf-8", "replace").rstrip() for r in raw[:, at : at + repeat]]
            at += repeat
            continue
        if code not in FIELDS:
            raise ValueError(f"fields of type {form} aren't read")
        size = np.dtype(FIELDS[code]).itemsize
        got = np.ascontiguousarray(raw[:, at : at + repeat * size]).view(FIELDS[code])
        at += repeat * size
        if code == "L":
            got = got == b"T"
        elif (scale := head.get(f"TSCAL{k}", 1), zero := head.get(f"TZERO{k}", 0)) != (1, 0):
            got = got * scale + zero
        got = got.astype(got.dtype.newbyteorder("="))
        out[name] = list(got) if repeat > 1 else got.ravel() if repeat else [None] * n
    return out


def table(spark: SparkSession, path: str | list[str], schema: str | StructType, extension: int = 1, glob: str = "*") -> DataFrame:
    """Rows of the tables in the files, with the columns that schema names (any case); missing numbers are null."""
    typed = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def rows(batches):
        for pdf in batches:
            for content in pdf["content"]:
                got = {k.lower(): v for k, v in _columns(*unit(content, extension)).items()}
                yield pd.DataFrame({f.name: pd.Series(got[f.name.lower()], dtype=None if isinstance(got[f.name.lower()], np.ndarray) else object) for f in typed.fields})

    out = _files(spark, path, glob).mapInPandas(rows, typed)
    floats = [f.name for f in typed.fields if f.dataType.typeName() in ("double", "float")]
    return out.withColumns({c: F.nanvl(c, F.lit(None).cast(typed[c].dataType)) for c in floats}) if floats else out


#: What the detection catalogues call their columns, and our names.
DETECTIONS = {"SeqNr": "ID", "X_IMAGE": "x", "Y_IMAGE": "y", "ALPHA_J2000": "ra", "DELTA_J2000": "dec", "MAG_GAAP_r": "mag_r"}


def detections(spark: SparkSession, path: str | list[str], glob: str = "*.cat") -> DataFrame:
    """ID, x, y, ra, dec, mag_r of detection catalogues; magnitudes of -99 and 99 are missing."""
    got = table(spark, path, "SeqNr long, X_IMAGE double, Y_IMAGE double, ALPHA_J2000 double, DELTA_J2000 double, MAG_GAAP_r double", glob=glob)
    named = got.select(*(F.col(a).alias(b) for a, b in DETECTIONS.items()))
    return named.withColumn("mag_r", F.when(~F.col("mag_r").isin(-99.0, 99.0), F.col("mag_r")))


def card(name: str, value) -> str:
    """A header card. Texts are quoted; one that doesn't fit its card raises."""
    if isinstance(value, (bool, np.bool_)):
        shown = f"{'T' if value else 'F':>20}"
    elif isinstance(value, str):
        shown = "'" + value.encode("ascii", "replace").decode().replace("'", "''").ljust(8) + "'"
    else:
        shown = f"{repr(float(value)).upper() if isinstance(value, (float, np.floating)) else int(value):>20}"
    if len(out := f"{name:<8}= {shown}") > CARD:
        raise ValueError(f"the value of {name} doesn't fit a card")
    return out.ljust(CARD)


def header(shape: tuple[int, int], bitpix: int, more: dict | None = None) -> bytes:
    """The header of a primary unit with a two-dimensional image, or of one without pixels. Values that are None or not finite have no card."""
    sides = {"NAXIS": 2, "NAXIS1": shape[1], "NAXIS2": shape[0]} if shape[0] and shape[1] else {"NAXIS": 0}
    known = {k: v for k, v in (more or {}).items() if v is not None and not (isinstance(v, (float, np.floating)) and not np.isfinite(v))}
    text = "".join(card(k, v) for k, v in ({"SIMPLE": True, "BITPIX": bitpix} | sides | known).items()) + "END".ljust(CARD)
    return text.ljust(-(-len(text) // RECORD) * RECORD).encode()


def encoded(image: np.ndarray, more: dict | None = None) -> bytes:
    """A single-precision image as a FITS file, with further cards."""
    data = np.ascontiguousarray(image, ">f4").tobytes()
    return header(image.shape, -32, more) + data + bytes(-len(data) % RECORD)
