"""Positions, tiles and matches on small cases."""

import math

import pytest
from pyspark.sql import functions as F

from astroloom.functions import names, sky
from astroloom.operators import crossmatch, images, tiles


def test_object_in_the_middle_of_a_tile_stands_on_pixel_5000(spark):
    d = spark.createDataFrame([(246, 289)], "xxx int, yyy int")
    ra0, dec0 = sky.tile_centre(F.col("xxx"), F.col("yyy"))
    o = d.select(F.lit(1).alias("ID"), ra0.alias("ra"), dec0.alias("dec"))
    row = tiles.assign(o, d).first()
    assert (row.tile, row.x, row.y) == ("(246, 289)", pytest.approx(5000), pytest.approx(5000))


def test_object_far_from_every_tile_has_none(spark):
    o = spark.createDataFrame([("a", 10.0, -60.0), ("b", None, None)], "ID string, ra double, dec double")
    rows = tiles.assign(o, spark.createDataFrame([(246, 289)], "xxx int, yyy int")).collect()
    assert len(rows) == 2 and all(r.tile is None and r.x is None for r in rows)


@pytest.mark.parametrize("ra", [359.99, 0.01])
def test_tiles_reach_across_ra_zero(spark, ra):
    o = spark.createDataFrame([(1, ra, 30.0)], "ID int, ra double, dec double")
    assert tiles.assign(o, spark.createDataFrame([(0, 240)], "xxx int, yyy int")).first().tile == "(0, 240)"


def test_matches_stay_under_the_radius_and_take_the_nearest(spark):
    det = spark.createDataFrame([(1, 359.9999, 10.0, "t"), (2, 0.0, 10.0, "t"), (3, 0.0, 10.0, "t")], "det_id int, ra double, dec double, tile string")
    lab = spark.createDataFrame([(1, 0.0, 10.0), (2, 0.0, 10.0 + 14.99 / 3600), (3, 0.0, 10.0 + 15.01 / 3600)], "label_id int, ra double, dec double")
    got = {r.label_id: r.det_id for r in crossmatch.nearest(lab, det, 15.0).collect()}
    assert got == {1: 2, 2: 2}
    assert crossmatch.nearest(lab, det.limit(0), 15.0).count() == 0
    assert crossmatch.unmatched(lab, crossmatch.nearest(lab.limit(0), det, 15.0)).count() == 3


def test_separation_of_a_degree(spark):
    a, b = (sky.unit_vector(F.lit(x), F.lit(0.0)) for x in (10.0, 11.0))
    assert math.isclose(spark.range(1).select(sky.separation(sky.chord(a, b))).first()[0], 3600, rel_tol=1e-9)


def test_names(spark):
    d = spark.createDataFrame([("CFIS.246.289.u.fits",), ("calexp-CFIS_246_289.fits",), ("PSS.DR4.243.290.i.fits",), ("junk",)], "n string")
    assert [r[0] for r in d.select(names.numbers_in(F.col("n"))).collect()] == [[246, 289], [246, 289], [243, 290], []]
    assert spark.range(1).select(names.padded(F.lit(1234), 3), names.padded(F.lit(7), 3)).first()[:] == ("1234", "007")


def test_cutout_at_the_edge_is_padded_and_one_outside_gives_none(spark):
    img = spark.createDataFrame([(1, 3, 3, [float(k) for k in range(9)])], "img int, ny int, nx int, pix array<float>")
    o = spark.createDataFrame([("edge", 1, 0.0, 0.0), ("out", 1, 50.0, 50.0)], "id string, img int, x double, y double")
    got = images.cutouts(o, images.to_blocks(img, ["img"], 2), ["img"], ["id"], 2, 2).collect()
    assert [(r.id, r.pix) for r in got] == [("edge", [0.0, 0.0, 0.0, 0.0])]


#: Positions of known galaxies with the tile and pixel that the survey gives them (ra, dec, xxx, yyy, x, y).
KNOWN = [
    (210.9375, 53.9444, 248, 288, 5272.605978908489, 3922.5752461594193),
    (212.1562, 54.3253, 246, 289, 1112.8468490735154, 1623.9625182097107),
    (210.7737, 53.6156, 251, 287, 7454.425703716308, 7243.892888604144),
    (211.89083, 54.71089, 246, 289, 4120.276396012283, 9087.340521854443),
    (211.1171, 55.6167, 239, 291, 3492.105869601455, 7263.024499588791),
    (212.07792, 55.19183, 243, 290, 2244.0341953593047, 8722.400178895885),
    (211.44792, 55.13258, 243, 290, 9219.451933662118, 7580.774125962493),
    (123.2432, 36.1984, 199, 252, 1020.9944945392867, 8850.019539934827),
    (123.6499, 36.4344, 199, 253, 7001.208727501078, 3730.0707073263675),
    (139.4972, 52.7426, 170, 285, 6531.84089371232, 9702.753925554882),
    (139.1897, 53.4429, 166, 287, 9012.86695414017, 3903.240240462025),
    (139.4444, 53.2935, 166, 287, 6076.747812265074, 998.9269385483763),
    (139.2389, 53.0101, 168, 286, 8951.187923465895, 5205.060467959228),
    (139.4253, 53.0271, 168, 286, 6777.094899750402, 5527.059039764314),
    (139.3098, 53.2298, 168, 286, 8108.602411594937, 9459.132939189147),
    (206.5777, 43.8514, 297, 268, 3065.768467506182, 2121.898050900346),
    (207.0967, 43.7087, 300, 267, 700.398383333144, 9052.36536979984),
    (206.6083, 43.4521, 300, 267, 7552.963379911458, 4074.527959708672),
    (206.99, 43.5872, 300, 267, 2189.440587526024, 6693.23285391598),
]


def test_known_galaxies_fall_on_their_tiles(spark):
    o = spark.createDataFrame([(k, r[0], r[1]) for k, r in enumerate(KNOWN)], "ID long, ra double, dec double")
    d = spark.createDataFrame(sorted({(r[2], r[3]) for r in KNOWN}), "xxx int, yyy int")
    for row in tiles.assign(o, d).collect():
        _, _, xxx, yyy, x, y = KNOWN[row.ID]
        assert (row.xxx, row.yyy) == (xxx, yyy)
        assert abs(row.x - x) < 1e-5 and abs(row.y - y) < 1e-5


def test_a_tile_beyond_ra_360(spark):
    """Tile numbers come from positions, so the last tiles of a row reach over ra 0."""
    o = spark.createDataFrame([(1, 3.2, -65.0)], "ID long, ra double, dec double")
    assert tiles.assign(o, spark.createDataFrame([(307, 50)], "xxx int, yyy int")).first().tile == "(307, 50)"


def test_attach_reads_labels_in_the_range_of_the_detections(spark, tmp_path):
    from astroloom.operators import labels

    det = spark.createDataFrame([(k, 10.0 + k, 20.0 + k, "a") for k in range(5)], "det_id long, ra double, dec double, tile string")
    rows = [(k, 10.0 + k, 20.0 + k, 0.0, 0.1 * k) for k in range(-3, 9)]
    spark.createDataFrame(rows, "label_id long, ra double, dec double, cspec double, zspec double").write.parquet(str(tmp_path / "z"))
    z = spark.read.parquet(str(tmp_path / "z"))
    none = spark.createDataFrame([], "label_id long, ra double, dec double, tile string")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # whole filters in the plan's text
    out = labels.attach(det, z, z.select("label_id", "ra", "dec"), none)
    assert {r.det_id: (r.zspec, r.lens) for r in out.collect()} == {k: (pytest.approx(0.1 * k), 1.0) for k in range(5)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "Scan parquet" in line]
    assert scans and all("GreaterThanOrEqual(dec," in line and "LessThanOrEqual(ra," in line for line in scans)
    assert labels.attach(det.limit(0), z, z.select("label_id", "ra", "dec"), none).count() == 0


@pytest.mark.parametrize("wide", [2, 4])
def test_nearest_equals_all_pairs(spark, monkeypatch, wide):
    import random

    monkeypatch.setattr(crossmatch, "WIDTH", wide)
    r = random.Random(wide)
    spots = [(0.0, 0.0), (359.9999, 45.0), (10.0, 89.9999), (200.0, -90.0), (77.0, -33.0)]
    near = lambda: (lambda a, d: ((a + r.uniform(-8, 8) / 3600) % 360, max(-90.0, min(90.0, d + r.uniform(-8, 8) / 3600))))(*r.choice(spots))
    det = [(k, *near(), r.choice("ab")) for k in range(150)]
    det += [(1000 + k, *d[1:]) for k, d in enumerate(det[:10])]  # ties: the least id holds
    lab = [(k, *near(), r.choice([1.0, 3.0, 10.0])) for k in range(200)]

    def vector(ra, dec):
        a, d = math.radians(ra), math.radians(dec)
        return math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)

    want = {}
    for k, ra, dec, reach in lab:
        for d, ra2, dec2, tile in det:
            sep = math.degrees(2 * math.asin(math.dist(vector(ra, dec), vector(ra2, dec2)) / 2)) * 3600
            if sep < reach:
                want[k, tile] = min(want.get((k, tile), (sep, d)), (sep, d))
    got = crossmatch.nearest(
        spark.createDataFrame(lab, "label_id long, ra double, dec double, own double"), spark.createDataFrame(det, "det_id long, ra double, dec double, tile string"), 10.0, each=["tile"], reach="own"
    ).collect()
    assert len(got) == len(want) > 100
    # Positions at a pole differ by rounding alone, so distances are compared, and ids only where positions are equal.
    assert all(r.sep == pytest.approx(want[r.label_id, r.tile][0], abs=1e-7) and r.det_id < 1000 for r in got)
