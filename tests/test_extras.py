"""Sources of catalogues, sinks, streams of tiles and background removal, on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from astroloom.functions import transforms
from astroloom.operators import crossmatch, images, labels
from astroloom.sinks import tables
from astroloom.sources import catalogs
from astroloom.streaming import tiles


def test_choice_of_a_catalogue(spark, tmp_path):
    path = str(tmp_path / "mine.v1.csv")
    with open(path, "w") as f:
        f.write("name,RA,DEC,lens\n007,210.5,54.25,\nx,bad,1,\n")
    c, name = catalogs.catalogue(spark, path=path, keys=("name", "RA", "DEC"), types={"lens": "double"})
    assert name == "mine" and dict(c.dtypes) == {"ID": "string", "ra": "double", "dec": "double", "lens": "double"}
    assert [tuple(r) for r in c.collect()] == [("007", 210.5, 54.25, None), ("x", None, 1.0, None)]
    with pytest.raises(ValueError, match="no column ID"):
        catalogs.catalogue(spark, path=path)
    with pytest.raises(ValueError, match="no source"):
        catalogs.catalogue(spark)
    got, name = catalogs.catalogue(spark, coords=[1, 2, 3, 4], path=path)
    assert name == "coordinates" and got.count() == 2
    assert catalogs.catalogue(spark, union=lambda: c, default=path)[0] is c
    assert catalogs.catalogue(spark, default=path, keys=("name", "RA", "DEC"))[1] == "mine"


def test_labels_of_stored_cutouts(spark, tmp_path):
    path = str(tmp_path / "224x224_ugriz_batch_1")
    rows = [(k, float(k), -float(k), k % 2, 7, 0.5, [float(k)] * 3) for k in range(6)]
    tables.cutouts(spark.createDataFrame(rows, "ID long, ra double, dec double, xxx int, yyy int, zspec double, images array<double>"), path)
    fresh = spark.createDataFrame([(2.0, -2.0, 0.25), (4.0, -4.0, 0.5), (99.0, 0.0, 1.0)], "ra double, dec double, zspec double")
    before = {f: open(f, "rb").read() for f in map(str, (tmp_path / "224x224_ugriz_batch_1" / "xxx=1").rglob("*.parquet"))}
    assert tables.relabelled(fresh, path, ["zspec"]) == 1
    assert {r.ID: r.zspec for r in spark.read.parquet(path).collect()} == {0: 0.5, 1: 0.5, 2: 0.25, 3: 0.5, 4: 0.5, 5: 0.5}
    assert all(open(f, "rb").read() == b for f, b in before.items())
    assert tables.relabelled(fresh, path, ["zspec"]) == 0
    master = tables.master_of_cutouts(spark, path)
    assert master.columns[:2] == ["ra", "dec"] and "images" not in master.columns
    assert {r.bands for r in master.collect()} == {"ugriz"}


def test_processed_catalogues_and_lists(spark, tmp_path):
    c = spark.createDataFrame([("a", 3), ("b", 5)], "ID string, n_bands int")
    tables.processed(c, str(tmp_path), "mine", 4)
    assert spark.read.option("header", True).csv(f"{tmp_path}/mine_processed").count() == 2
    assert [r.ID for r in spark.read.option("header", True).csv(f"{tmp_path}/mine_processed_complete").collect()] == ["b"]
    tables.name_list(spark.createDataFrame([("b.h5",), ("a.h5",), ("c.txt",)], "name string"), f"{tmp_path}/names", ".h5")
    assert [r.value for r in spark.read.text(f"{tmp_path}/names").collect()] == ["a.h5", "b.h5"]
    tables.tile_catalogue(spark.createDataFrame([("a", 1, 2, [1.0])], "ID string, xxx int, yyy int, images array<double>"), f"{tmp_path}/cat")
    assert spark.read.parquet(f"{tmp_path}/cat").select("ID", "cfis_id").first() == ("a", "a")


def test_stream_of_tiles_cuts_measures_and_accounts(spark, tmp_path):
    pix = np.arange(64, dtype=np.float32)
    image = spark.createDataFrame([(1, 2, b, 8, 8, (pix + k).tolist()) for k, b in enumerate("gr")], "xxx int, yyy int, band string, ny int, nx int, pix array<float>")
    blocks = images.to_blocks(image, ["xxx", "yyy", "band"], 4)
    objects = spark.createDataFrame([("a", 1, 2, 4.0, 4.0, 10.0, 20.0, 1.0), ("b", 3, 3, 1.0, 1.0, 0.0, 0.0, None)], "ID string, xxx int, yyy int, x double, y double, ra double, dec double, lsb double")
    spark.createDataFrame([(1, 2), (3, 3)], "xxx int, yyy int").coalesce(1).write.parquet(f"{tmp_path}/work")
    stream = tiles.arriving(spark, f"{tmp_path}/work", "xxx int, yyy int")
    made = tiles.cut(blocks, objects, ["xxx", "yyy", "band"], ["ID"], 4, ["g", "r"], 4, ["lsb"])
    tiles.accounted(stream, made, f"{tmp_path}/out", f"{tmp_path}/status", f"{tmp_path}/c1", ["xxx", "yyy"]).awaitTermination()
    (row,) = spark.read.parquet(f"{tmp_path}/out").collect()
    want = pix.reshape(8, 8)[2:6, 2:6].ravel()
    assert (row.ID, row.lsb, row.ra) == ("a", 1.0, 10.0)
    np.testing.assert_array_equal(row.images, [want, want + 1])
    status = spark.read.parquet(f"{tmp_path}/status")
    assert {(r.xxx, r.yyy): r.status for r in status.collect()} == {(1, 2): "made", (3, 3): "failed"}
    manifest = spark.createDataFrame([(1, 2), (3, 3), (5, 5)], "xxx int, yyy int")
    assert {r.xxx: r.status for r in tiles.queue(manifest, status, ["xxx", "yyy"]).collect()} == {1: "made", 3: "failed", 5: "waiting"}
    stats = tiles.measured(blocks, ["xxx", "yyy", "band"])
    tiles.delivered(tiles.arriving(spark, f"{tmp_path}/work", "xxx int, yyy int"), stats, f"{tmp_path}/stats", f"{tmp_path}/c2").awaitTermination()
    assert {r.band: (r.n_valid_pixels, r.max) for r in spark.read.parquet(f"{tmp_path}/stats").collect()} == {"g": (64, 63.0), "r": (64, 64.0)}


def test_a_band_that_comes_twice(spark):
    cut = spark.createDataFrame([(1, "g", [1.0, 1.0]), (1, "g", [2.0, 0.0])], "ID int, band string, pix array<double>")
    assert images.stacks(cut, ["ID"], ["g", "r"], 1, compact=True).first().images == [[2.0, 0.0]]


def test_background_is_removed_and_noise_is_the_same_again():
    r = np.random.default_rng(1)
    slope = np.add.outer(np.linspace(0, 8, 256), np.linspace(0, 4, 256))
    image = slope + r.normal(20, 1, slope.shape)
    image[5, 5] = np.nan
    out = transforms.background_removed(image, 7, mesh=64, least=-50)
    assert abs(np.median(out)) < 0.2 and np.isfinite(out).all() and np.std(out) < 2
    np.testing.assert_array_equal(out, transforms.background_removed(image, 7, mesh=64, least=-50))
    assert (transforms.background_removed(image, 7, mesh=64, least=-0.1)[np.isfinite(image)] > -8).all()
    assert np.isfinite(transforms.background_removed(np.full((4, 4), np.nan), 1)).all()


def test_last_redshift_holds_and_range_follows_detections(spark):
    det = spark.createDataFrame([(1, 10.0, 5.0, "(1, 1)"), (2, 50.0, 5.0, "(2, 2)")], "det_id long, ra double, dec double, tile string")
    z = spark.createDataFrame([(1, 10.0, 5.0, 1.0, 0.1), (2, 10.0, 5.0 + 0.2 / 3600, None, 0.2), (3, 200.0, 5.0, 1.0, 0.3)], "label_id long, ra double, dec double, cspec double, zspec double")
    lens = z.select("label_id", "ra", "dec").where("label_id = 1")
    dwarf = spark.createDataFrame([(1, 50.0, 5.0 + 3 / 3600, "(2, 2)"), (2, 50.0, 5.0, "(9, 9)")], "label_id long, ra double, dec double, tile string")
    rows = {(r.det_id, r.tile): (r.class_label, r.zspec, r.lens, r.lsb) for r in labels.attach(det, z, lens, dwarf).collect()}
    assert rows == {(1, "(1, 1)"): (None, 0.2, 1.0, None), (2, "(2, 2)"): (2.0, None, None, 1.0), (None, "(9, 9)"): (2.0, None, None, 1.0)}
    assert {r.label_id for r in labels.in_range_of(z, det).collect()} == {1, 2}
    assert labels.in_range_of(z, det.limit(0)).count() == 0
    assert {r.label_id for r in labels.in_range_of(z, det.withColumn("ra", F.lit(359.9999))).collect()} == {1, 2, 3}


def test_union_by_own_keys(spark):
    a = spark.createDataFrame([("x", 10.0, 5.0), ("y", 20.0, 5.0)], "label_id string, ra double, dec double")
    b = spark.createDataFrame([(1, 10.0, 5.0 + 3 / 3600), (2, 30.0, 5.0), (3, 40.0, 5.0)], "det_id long, ra double, dec double")
    assert {(r.label_id, r.det_id) for r in crossmatch.union_catalogs(a, b).collect()} == {("y", None), (None, 1), (None, 2), (None, 3)}
    assert {(r.label_id, r.det_id) for r in crossmatch.union_catalogs(b, a, a_key="det_id", b_key="label_id").collect()} == {("y", None), (None, 1), (None, 2), (None, 3)}
