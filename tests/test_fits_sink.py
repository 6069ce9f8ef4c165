"""FITS files written by tasks and read back by the sources."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from astroloom.functions import sky
from astroloom.sinks import fits as sink
from astroloom.sources import fits
from astroloom.sources.compressed import cutouts


def rows(spark, n: int = 40):
    rng = np.random.default_rng(2)
    out = [(f"cut/{k}", 4 + k % 3, 5, rng.normal(0, 1, (4 + k % 3) * 5).astype(np.float32).tolist(), 10.0 + k, -30.0 + k, 1e-4 * (1 + k % 2), f"o'b {k}", k, k % 2 == 0, float("nan") if k % 4 else 0.1 * k) for k in range(n)]
    return spark.createDataFrame(out, "name string, ny int, nx int, pix array<float>, ra double, dec double, scale double, OBJECT string, NUMBER long, GOOD boolean, ZSPEC double").repartition(6)


def files(path) -> list[str]:
    """What readers see."""
    return sorted(f for at, _, fs in os.walk(path) for f in fs if not f.startswith(".") and "_started" not in at)


def test_written_cutouts_read_back_with_positions(spark, tmp_path):
    path = str(tmp_path / "cuts")
    want = {r.name: r for r in rows(spark).collect()}
    sink.write(rows(spark), path)
    assert len(files(path)) == len(want) and not [f for f in os.listdir(path) if f.startswith("_")]
    name = F.concat(F.lit("cut/"), F.regexp_extract("path", r"cut_(\d+)\.fits", 1)).alias("name")
    got = {r.name: r for r in fits.image_blocks(spark, path, 0).select(name, "h", "w", "pix").collect()}
    assert {k: (r.h, r.w, r.pix) for k, r in got.items()} == {k: (r.ny, r.nx, r.pix) for k, r in want.items()}
    heads = fits.headers(spark, path, 0).select(name, "cards")
    for r in heads.collect():
        w = want[r.name]
        assert (r.cards["OBJECT"], int(r.cards["NUMBER"]), r.cards["GOOD"]) == (w.OBJECT, w.NUMBER, str(w.GOOD))
        assert float(r.cards["ZSPEC"]) == w.ZSPEC if w.NUMBER % 4 == 0 else "ZSPEC" not in r.cards
        assert (float(r.cards["CRVAL1"]), float(r.cards["CRVAL2"])) == (w.ra, w.dec)
    # the middle, and a place a few pixels away, by the cards alone
    c = lambda n: F.element_at("cards", n).cast("double")
    place = lambda ra, dec: sky.pixel_of_header(ra, dec, (c("CRVAL1"), c("CRVAL2")), (c("CRPIX1"), c("CRPIX2")), tuple(c(f"CD{i}_{j}") for i in (1, 2) for j in (1, 2)))
    at = heads.select("name", *place(c("CRVAL1"), c("CRVAL2")), *place(c("CRVAL1"), c("CRVAL2") + 2 * c("CD2_2")), *place(c("CRVAL1") + 1e-4, c("CRVAL2"))).collect()
    for n, x, y, x2, y2, x3, _ in at:
        assert (x, y) == (3.0, (want[n].ny + 1) / 2) and x2 == pytest.approx(3) and y2 == pytest.approx(y + 2) and x3 < x


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    path = str(tmp_path / "cuts")
    sink.write(rows(spark, 5), path)
    before = files(path)
    bad = rows(spark).withColumn("ny", F.when(F.col("NUMBER") == 33, 99).otherwise(F.col("ny")))  # pixels that don't fill the sides
    with pytest.raises(Exception, match="reshape"):
        sink.write(bad, path)
    assert files(path) == before and fits.headers(spark, path, 0).count() == len(before)


def test_appended_and_replaced(spark, tmp_path):
    path = str(tmp_path / "cuts")
    sink.write(rows(spark, 5), path)
    sink.write(rows(spark, 3), path)
    assert len(files(path)) == 8
    sink.write(rows(spark, 2), path, "overwrite")
    assert files(path) == ["cut_0.fits", "cut_1.fits"]
    sink.write(rows(spark).limit(0), path, "overwrite")
    assert files(path) == []


def test_odd_rows(spark, tmp_path):
    path = str(tmp_path / "cuts")
    odd = spark.createDataFrame([("a", 1, 2, [1.0, float("nan")], None, 5.0), ("a", 1, 1, [3.0], 2.0, 1.0), ("b", 0, 0, [], 1.0, 1.0), ("ü", None, None, None, None, None)], "name string, ny int, nx int, pix array<double>, ra double, dec double")
    sink.write(odd.coalesce(1), path)
    assert files(path) == ["a.2.fits", "a.fits", "b.fits", "ü.fits"]
    heads = {os.path.basename(r.path): r.cards for r in fits.headers(spark, path, 0).collect()}
    assert "CRVAL1" not in heads["a.fits"] and heads["a.2.fits"]["CRVAL1"] == "2.0" and float(heads["a.2.fits"]["CD2_2"]) == sky.SCALE
    assert fits.image_blocks(spark, path, 0).count() == 2
    for wrong, match in ((odd.withColumn("lower", F.lit(1)), "card"), (odd.drop("pix"), "need"), (odd.withColumn("NAXIS", F.lit(1)), "card")):
        with pytest.raises(Exception, match=match):
            sink.write(wrong, path)
    with pytest.raises(Exception, match="no name"):
        sink.write(odd.withColumn("name", F.lit(None).cast("string")), path)


def test_an_extension_becomes_the_primary_unit(spark, tmp_path, monkeypatch):
    image = np.arange(90 * 70, dtype=np.float32).reshape(90, 70)
    head = fits.header(image.shape, -32, {"CRVAL1": 12.5, "OBJECT": "it's"}).replace(b"SIMPLE  =                    T", b"XTENSION= 'IMAGE   '          ")
    data = image.astype(">f4").tobytes()
    (tmp_path / "two.fits").write_bytes(fits.header((0, 0), 8) + head + data + bytes(-len(data) % 2880))
    path = str(tmp_path / "one")
    one = spark.createDataFrame([("one", str(tmp_path / "two.fits"), 1, "i")], "name string, source string, extension int, BAND string")
    sink.write(one, path)
    (r,) = fits.headers(spark, path, 0).collect()
    assert r.cards["SIMPLE"] == "True" and "XTENSION" not in r.cards and (r.cards["CRVAL1"], r.cards["OBJECT"], r.cards["BAND"]) == ("12.5", "it's", "i")
    place = spark.createDataFrame([(1, r.path, 35.0, 45.0)], "id int, path string, x double, y double")
    (got,) = cutouts(place, ["id"], 8, 0).collect()
    np.testing.assert_array_equal(np.sort(np.array(got.pix)), np.sort(image[41:49, 31:39].ravel()))
    with pytest.raises(Exception, match="no plain image"):
        sink.write(one.withColumn("extension", F.lit(0)), path)
