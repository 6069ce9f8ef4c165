"""FITS files as a sink: a file for each row, with its position on the sky.

A data source writes them. Tasks write into a folder of their own under `_started-<job>`, which Spark's readers pass over; once all are
done the driver takes away what attempts that don't count have left and gives that folder its name, in one rename, so readers see all files of
a job or none. A job that fails is cleared away; what
a task writes that is killed after that stays in the folder that readers pass over. A task's files lie together, so what the driver moves doesn't grow with the files.

Rows: name (of the file, without its ending), and either ny, nx and pix (row by row), with ra, dec (degrees, the middle of the image) and
scale (degrees a pixel) if they are known; or source and extension, an image in another file, which becomes the primary unit of its own
file, read and written by ranges. Any other column is a card.

Defined results: a null or empty pix is a file without pixels; without ra or dec a file has no position; cards that are null or not
a number are left out; characters that FITS has none for are written as ?; slashes in names as _; rows of one name in a task get .2, .3 and so on, those of
other tasks lie in other folders; a null name, a column that can't be a card's name, and a source that isn't a plain image raise; an empty table leaves
the folder without files. Stores must be able to rename folders (local, shared, hdfs)."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions import sky
from ..sources import compressed, fits
from ..sources.stores import Ranges, store

PIXELS, POSITION, COPIED = ("ny", "nx", "pix"), ("ra", "dec", "scale"), ("source", "extension")
#: Bytes of a copied image that are held at once.
CHUNK = 8 << 20
#: Cards of an extension that a primary unit has otherwise or not at all.
OWN = ("SIMPLE", "XTENSION", "BITPIX", "NAXIS", "NAXIS1", "NAXIS2", "PCOUNT", "GCOUNT", "EXTNAME", "EXTVER", "EXTLEVEL", "EXTEND", "CHECKSUM", "DATASUM", "END")


def position_cards(ny: int, nx: int, ra: float | None, dec: float | None, scale: float | None) -> dict:
    """A tangent plane at the middle of the image, right ascension growing to the left. None without a position."""
    if ra is None or dec is None or math.isnan(ra) or math.isnan(dec):
        return {}
    scale = sky.SCALE if scale is None else scale
    return {
        "CTYPE1": "RA---TAN", "CTYPE2": "DEC--TAN", "CUNIT1": "deg", "CUNIT2": "deg", "CRVAL1": ra, "CRVAL2": dec,
        "CRPIX1": (nx + 1) / 2, "CRPIX2": (ny + 1) / 2, "CD1_1": -scale, "CD1_2": 0.0, "CD2_1": 0.0, "CD2_2": scale,
    }


@dataclass
class _Written(WriterCommitMessage):
    folder: str | None


class _Writer(DataSourceArrowWriter):
    def __init__(self, columns: list[str], path: str, overwrite: bool):
        self.columns, self.path, self.overwrite, self.job = columns, path.rstrip("/"), overwrite, uuid.uuid4().hex

    def _staging(self) -> str:
        return f"{self.path}/_started-{self.job}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        task = TaskContext.get()
        folder = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        files, inner = store(f"{self._staging()}/{folder}")
        others = [c for c in self.columns if c not in ("name", *PIXELS, *POSITION, *COPIED)]
        used: dict[str, int] = {}
        for batch in iterator:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in self.columns if c != "pix"}
                if r["name"] is None:
                    raise ValueError("a file has no name")
                if not used:
                    files.create_dir(inner, recursive=True)
                name = r["name"].replace("/", "_")
                used[name] = used.get(name, 0) + 1
                ending = f".{used[name]}.fits" if used[name] > 1 else ".fits"
                extra = {c: r[c] for c in others}
                with files.open_output_stream(f"{inner}/{name}{ending}") as out:
                    if "source" in r:
                        _copy(out, r["source"], r["extension"], extra)
                        continue
                    pix = batch.column("pix").slice(k, 1).flatten().to_numpy(zero_copy_only=False)
                    image = pix.reshape(r["ny"], r["nx"]) if len(pix) else np.zeros((0, 0), np.float32)
                    place = position_cards(*image.shape, *(r.get(c) for c in POSITION)) if len(pix) else {}
                    out.write(fits.encoded(image, place | extra))
        return _Written(folder if used else None)

    def commit(self, messages: list) -> None:
        files, inner = store(self._staging())
        kept = {m.folder for m in messages if m is not None and m.folder}
        files.create_dir(store(self.path)[1], recursive=True)
        old = self._jobs() if self.overwrite else []
        if kept:
            for found in _entries(files, inner):
                if found.base_name not in kept:
                    files.delete_dir(found.path)
            files.move(inner, f"{store(self.path)[1]}/job-{self.job}")
        else:
            self.abort(messages)
        for path in old:
            files.delete_dir(path)

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        files, inner = store(self._staging())
        if files.get_file_info(inner).type == fs.FileType.Directory:
            files.delete_dir(inner)

    def _jobs(self) -> list[str]:
        files, inner = store(self.path)
        return [f.path for f in _entries(files, inner) if f.base_name.startswith("job-")]


def _entries(files, inner: str) -> list:
    from pyarrow import fs

    return files.get_file_info(fs.FileSelector(inner, allow_not_found=True))


def _copy(out, path: str, extension: int, extra: dict) -> None:
    """An image of another file as a primary unit, with the cards it had."""
    source = Ranges(path)
    head, start = compressed.opened(source, extension)
    if head.get("XTENSION", "IMAGE") != "IMAGE" or head.get("NAXIS") != 2 or head.get("ZIMAGE"):
        raise ValueError(f"extension {extension} of {path} is no plain image")
    out.write(fits.header((head["NAXIS2"], head["NAXIS1"]), head["BITPIX"], {k: v for k, v in head.items() if k not in OWN} | extra))
    size = fits.data_size(head)
    for at in range(0, size, CHUNK):
        out.write(source.read(start + at, min(CHUNK, size - at)))
    out.write(bytes(-size % fits.RECORD))
    source.close()


class Images(DataSource):
    """df.write.format("fits_images")."""

    @classmethod
    def name(cls) -> str:
        return "fits_images"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        names = schema.names
        if "name" not in names or not (set(PIXELS) <= set(names) or set(COPIED) <= set(names)):
            raise ValueError(f"rows need name and {', '.join(PIXELS)}, or name and {', '.join(COPIED)}")
        for c in names:
            if c not in ("name", *PIXELS, *POSITION, *COPIED) and (not re.fullmatch(r"[A-Z0-9_-]{1,8}", c) or c in OWN):
                raise ValueError(f"{c} can't be the name of a card")
        return _Writer(names, self.options["path"], overwrite)


def write(rows: DataFrame, path: str, mode: str = "append") -> None:
    """rows as FITS files under path. mode: append, or overwrite, which takes away the files of earlier jobs once the new ones are there."""
    rows.sparkSession.dataSource.register(Images)
    rows.write.format("fits_images").mode(mode).save(path)
