"""Files written here and read back by the sources."""

import numpy as np
import pytest

from astroloom.sources import fits, text


def test_fits_image_round_trip(spark, tmp_path):
    image = np.arange(70 * 50, dtype=np.float32).reshape(70, 50)
    image[3, 4] = np.nan
    (tmp_path / "CFIS.246.289.u.fits").write_bytes(fits.encoded(image))
    back = np.zeros_like(image)
    for r in fits.image_blocks(spark, str(tmp_path), block=32).collect():
        back[r.by * 32 : r.by * 32 + r.h, r.bx * 32 : r.bx * 32 + r.w] = np.array(r.pix, np.float32).reshape(r.h, r.w)
    np.testing.assert_array_equal(back, image)
    row = fits.headers(spark, str(tmp_path)).select(*(c.alias(n) for n, c in fits.scale_of("cards").items())).first()
    assert (row.nx, row.ny, row.scale) == (50, 70, None)


def _cards(*cards: tuple[str, str]) -> bytes:
    head = "".join(f"{k:<8}= {v}".ljust(80) for k, v in cards) + "END".ljust(80)
    return head.ljust(-(-len(head) // 2880) * 2880).encode()


EMPTY = _cards(("SIMPLE", "T"), ("BITPIX", "8"), ("NAXIS", "0"))


def test_fits_tables(spark, tmp_path):
    rows = [b" a1 1.50", b"b22     "]
    head = _cards(("XTENSION", "'TABLE   '"), ("BITPIX", "8"), ("NAXIS", "2"), ("NAXIS1", "8"), ("NAXIS2", "2"), ("PCOUNT", "0"), ("GCOUNT", "1"), ("TFIELDS", "2"), ("TTYPE1", "'ID'"), ("TFORM1", "'A3'"), ("TBCOL1", "1"), ("TTYPE2", "'mag'"), ("TFORM2", "'F4.2'"), ("TBCOL2", "5"))
    (tmp_path / "text.fits").write_bytes(EMPTY + head + b"".join(rows).ljust(2880))
    got = fits.table(spark, str(tmp_path / "text.fits"), "id string, mag double").collect()
    assert [tuple(r) for r in got] == [("a1", 1.5), ("b22", None)]

    data = np.array([(7, 1.25, -99.0), (8, np.nan, 21.0)], dtype=[("a", ">i4"), ("b", ">f8"), ("c", ">f8")]).tobytes()
    names = [("SeqNr", "J"), ("X_IMAGE", "D"), ("MAG_GAAP_r", "D")]
    head = _cards(("XTENSION", "'BINTABLE'"), ("BITPIX", "8"), ("NAXIS", "2"), ("NAXIS1", "20"), ("NAXIS2", "2"), ("PCOUNT", "0"), ("GCOUNT", "1"), ("TFIELDS", "3"), *((f"{k}{i}", f"'{v}'") for i, pair in enumerate(names, 1) for k, v in zip(("TTYPE", "TFORM"), pair, strict=True)))
    (tmp_path / "binary.cat").write_bytes(EMPTY + head + data.ljust(2880, b"\0"))
    got = fits.table(spark, str(tmp_path / "binary.cat"), "SeqNr long, X_IMAGE double, MAG_GAAP_r double").collect()
    assert [tuple(r) for r in got] == [(7, 1.25, -99.0), (8, None, 21.0)]
    with pytest.raises(Exception, match="no extension 5"):
        fits.table(spark, str(tmp_path / "binary.cat"), "SeqNr long", extension=5).collect()


def test_text_sources(spark, tmp_path):
    (tmp_path / "fixed.csv").write_text("ab  1.5\n\ncdef   \n")
    got = text.fixed_width(spark, str(tmp_path / "fixed.csv"), {"name": (0, 4, "string"), "v": (4, 3, "double")}).collect()
    assert [tuple(r) for r in got] == [("ab", 1.5), ("cdef", None)]
    (tmp_path / "cuts.txt").write_text("tile ra_min\n246.289   12.5\n 1.2\n")
    got = text.white_space(spark, str(tmp_path / "cuts.txt"), "tile string, ra_min double", header=True).collect()
    assert [tuple(r) for r in got] == [("246.289", 12.5), ("1.2", None)]
    (tmp_path / "u_tiles.txt").write_text("CFIS.246.289.u.fits\n\n")
    assert [tuple(r) for r in text.name_lists(spark, str(tmp_path)).collect()] == [("u", "CFIS.246.289.u.fits")]


def test_ledger_and_folders(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert text.ledger(spark, path).count() == 0
    df = spark.createDataFrame([("(1, 2)",), ("(1, 2)",), ("(3, 4)",)], "tile string")
    text.to_ledger(df.tile, df, path)
    text.to_ledger(df.tile, df, path)
    assert sorted(r.entry for r in text.ledger(spark, path).collect()) == ["(1, 2)", "(3, 4)"]
    for folder in ("UNIONS.246.289", "UNIONS.x.1", "UNIONS.086.337"):
        (tmp_path / "cats" / folder).mkdir(parents=True)
        (tmp_path / "cats" / folder / f"{folder}_ugri_photoz_ext.cat").write_text("x")
    files = text.listed_files(spark, str(tmp_path / "cats"), "*.cat")
    assert [tuple(r) for r in text.tile_folders(files, left_out=[(86, 337)]).collect()] == [(246, 289)]


def test_coordinates(spark):
    assert [tuple(r) for r in text.coordinates(spark, [1, 2, 3, 4]).collect()] == [(1, 1.0, 2.0), (2, 3.0, 4.0)]
    with pytest.raises(ValueError, match="pairs"):
        text.coordinates(spark, [1])
