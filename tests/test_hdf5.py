"""HDF5 files of cutouts, in the forms that the format's older and newer writers give them."""

from __future__ import annotations

import hdf5_files as H
import numpy as np
import pytest

from astroloom.sources import hdf5
from astroloom.sources.stores import Ranges

N, BANDS, SIDE = 23, 2, 5
RNG = np.random.default_rng(5)
IMAGES = RNG.normal(0, 1, (N, BANDS, SIDE, SIDE)).astype("<f4")
TILES = RNG.integers(0, 400, (N, 2)).astype("<i4")
RA, ZSPEC = RNG.uniform(0, 360, N).astype("<f4"), np.where(np.arange(N) % 3, np.nan, 0.5).astype("<f4")
IDS = [f"[A] {k} é" if k % 4 else "" for k in range(N)]
WIDE = "images array<float>, tile array<int>, known_id string, ra float, zspec float"


def want(tile=None) -> list:
    z = lambda v: None if np.isnan(v) else float(v)
    return [(IMAGES[k].ravel().tolist(), (TILES[k] if tile is None else tile).tolist(), IDS[k], float(RA[k]), z(ZSPEC[k])) for k in range(N)]


def plain(rows) -> list:
    return sorted((tuple(None if isinstance(v, float) and v != v else v for v in r) for r in rows), key=lambda r: r[3])


def by_ra(rows) -> list:
    return sorted(rows, key=lambda r: r[3])


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("h5")
    columns = {"images": IMAGES, "tile": TILES, "known_id": IDS, "ra": RA, "zspec": ZSPEC}
    small = np.array([s.encode() for s in IDS])
    made = {
        "old": H.old(columns | {"known_id": small}, {"images": (4, 1, 3, 5), "ra": (6,)}),
        "dense": H.dense(columns | {"tile": np.array([7, 9], "<i4")} | {f"more{k}": RA for k in range(5)}),
        "growing": H.growing(columns, {"images": (3, 1, 5, 4)}),
        "deflated": H.growing(columns, {"images": (23, 2, 5, 5), "ra": (1,), "zspec": (2,)}, True),
    }
    for name, raw in made.items():
        (d / name).mkdir()
        (d / name / "246_289_5x5_ug.h5").write_bytes(raw)
    return d


@pytest.mark.parametrize("form", ["old", "dense", "growing", "deflated"])
def test_rows_of_each_form(spark, files, form):
    got = hdf5.cutouts(spark, str(files / form), WIDE, split_bytes=2000)
    assert got.rdd.getNumPartitions() > 1
    assert plain(got.collect()) == by_ra(want(np.array([7, 9]) if form == "dense" else None))


def test_schema_of_the_first_file(spark, files):
    got = hdf5.cutouts(spark, str(files / "growing"))
    kinds = {f.name: f.dataType.simpleString() for f in got.schema}
    assert kinds == {"images": "array<float>", "tile": "array<int>", "known_id": "string", "ra": "float", "zspec": "float"}
    assert got.count() == N and got.where("ra is null").count() == 0


def test_columns_that_are_absent_and_types_that_widen(spark, files):
    got = hdf5.cutouts(spark, f"file://{files / 'old'}", "RA_ float, ra double, known_id string")
    assert got.where("RA_ is not null").count() == 0
    assert sorted(r["ra"] for r in got.collect()) == sorted(map(float, RA))


def test_a_choice_of_columns_leaves_images_unread(files):
    path = str(next((files / "deflated").glob("*.h5")))
    source = Ranges(path)
    file = hdf5.File(source)
    source.bytes_read = 0
    assert np.array_equal(file.dataset("ra").values(5, 9), RA[5:9])
    images = file.dataset("images").chunks()
    assert source.bytes_read < 4000 < sum(n for _, n, _ in images.values())
    source = Ranges(str(next((files / "growing").glob("*.h5"))))
    d = hdf5.File(source).dataset("images")
    d.rows(0, 1)
    before = source.bytes_read
    assert np.array_equal(d.rows(3, 5), IMAGES[3:5]) and source.bytes_read - before == 2 * 2 * d.chunk_bytes


def test_empty_and_broken_files(spark, tmp_path):
    none = {"images": IMAGES[:0], "tile": TILES[:0], "ra": RA[:0]}
    (tmp_path / "a.h5").write_bytes(H.growing(none, {}))
    assert hdf5.cutouts(spark, str(tmp_path), "images array<float>, ra float").count() == 0
    (tmp_path / "empty").mkdir()
    assert hdf5.cutouts(spark, str(tmp_path / "empty"), "ra float").count() == 0
    for k, raw in enumerate((b"", b"no such format" * 9, H.dense({"ra": RA})[:300])):
        (tmp_path / f"{k}.bad").write_bytes(raw)
        with pytest.raises((ValueError, OSError)):
            hdf5.File(Ranges(str(tmp_path / f"{k}.bad"))).dataset("ra").values(0, 2)


def test_unwritten_chunks_are_zero(tmp_path):
    raw = H.growing({"ra": np.arange(1, 40, dtype="<f4")}, {"ra": (1,)})
    b = bytearray(raw)
    at = b.rindex(b"EADB")  # the last data block: its elements are lost
    b[at + 18 : at + 26] = H.NONE
    (tmp_path / "a.h5").write_bytes(bytes(b))
    got = hdf5.File(Ranges(str(tmp_path / "a.h5"))).dataset("ra").values(0, 39)
    assert (got == 0).sum() == 1 and (got[got > 0] == np.arange(1, 40)[got > 0]).all()
