"""Small functions that no query calls, the label range among them."""

from __future__ import annotations

import math
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from astroloom.functions import names, sky, transforms
from astroloom.operators import anomalies, derived
from astroloom.sources import fits
from astroloom.streaming import tiles


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_angles_and_lengths(spark):
    arcsec, kpc = one(spark, sky.arcsec_of_kpc(F.lit(1.0), F.lit(10.0)), sky.kpc_of_arcsec(F.lit(20.62648), F.lit(10.0)))
    assert arcsec == pytest.approx(20.62648, rel=1e-6) and kpc == pytest.approx(1.0, rel=1e-6)
    assert one(spark, sky.kpc_of_arcsec(sky.arcsec_of_kpc(F.lit(3.3), F.lit(7.0)), F.lit(7.0)))[0] == pytest.approx(3.3)


def test_pixel_of_a_header_equals_that_of_a_tile(spark):
    s = sky.SCALE
    own = sky.pixel_of_header(F.lit(210.1), F.lit(54.2), (F.lit(210.0), F.lit(54.0)), (5000.0, 5000.0), (-s, 0.0, 0.0, s))
    tile = sky.pixel(F.lit(210.1), F.lit(54.2), F.lit(210.0), F.lit(54.0))
    x, y, x2, y2 = one(spark, *own, *tile)
    assert (x, y) == pytest.approx((x2, y2))
    turned = sky.pixel_of_header(F.lit(210.1), F.lit(54.2), (F.lit(210.0), F.lit(54.0)), (1.0, 2.0), (0.0, s, s, 0.0))
    x3, y3 = one(spark, *turned)
    assert (x3 - 1, y3 - 2) == pytest.approx((y - 5000, -(x - 5000)))
    assert one(spark, *sky.pixel_of_header(F.lit(30.0), F.lit(-54.0), (F.lit(210.0), F.lit(54.0)), (1.0, 2.0), (-s, 0.0, 0.0, s)))[:] == (None, None)


def test_names_and_indices(spark):
    row = one(
        spark,
        names.base_name(F.lit("/a/b/246_289_224x224_ugriz_batch_1.h5")),
        names.bands_of_path(F.lit("/a/246_289_224x224_ugriz_batch_1.h5")),
        names.band_indices(F.array(F.lit("z"), F.lit("u"), F.lit("q")), ["u", "g", "r", "i", "z"]),
        names.parsed_tuple(F.lit("(246, 289)")),
    )
    assert row[:] == ("246_289_224x224_ugriz_batch_1.h5", "ugriz", [-1, 0, 4], [246, 289])


def test_an_order_that_looks_random_and_stays(spark):
    df = spark.range(200)
    a, b, c = ([r[0] for r in derived.shuffled(x, ["id"], s).collect()] for x, s in ((df, 1), (df.repartition(5), 1), (df, 2)))
    assert a == b and a != c and sorted(a) == list(range(200)) != a


def test_fourier_and_backgrounds_of_rows(spark):
    r = np.random.default_rng(1)
    flat, cross = r.normal(0, 1, (200, 200)), r.normal(0, 1, (200, 200))
    cross[100, :] += 50
    cross[:, 100] += 50
    df = spark.createDataFrame([(k, 200, 200, x.ravel().tolist()) for k, x in enumerate((flat, cross))] + [(2, 0, 0, None)], "id int, ny int, nx int, pix array<float>")
    got = {x["id"]: x for x in anomalies.fourier_anomalies(df, ["id"]).collect()}
    assert [got[k]["anomaly"] for k in range(3)] == [False, True, None]
    assert got[1]["vertical"] == pytest.approx(transforms.fourier_anomaly(cross.astype(np.float32))[0], rel=1e-6)
    rms = {x["id"]: x["rms"] for x in anomalies.backgrounds(df, ["id"], 50).collect()}
    assert rms[0] == pytest.approx(1, rel=0.1) and rms[2] is None


def test_running_totals_of_a_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(90).select((F.col("id") % 3).cast("int").alias("k"), F.col("id").alias("v")).repartition(4).write.parquet(folder)
    totals = tiles.running_totals(tiles.arriving(spark, folder, "k int, v long"), ["k"], n=F.count(F.lit(1)), s=F.sum("v"))
    totals.writeStream.format("memory").queryName("totals").outputMode("complete").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table("totals").collect())) == [(k, 30, sum(range(k, 90, 3))) for k in range(3)]


def test_detection_tables(spark, tmp_path):
    fields = [("SeqNr", "K", ">i8", [1, 2]), ("X_IMAGE", "D", ">f8", [1.5, 2.5]), ("Y_IMAGE", "D", ">f8", [3.0, 4.0]), ("ALPHA_J2000", "D", ">f8", [210.0, 211.0]), ("DELTA_J2000", "D", ">f8", [54.0, 55.0]), ("MAG_GAAP_r", "E", ">f4", [99.0, 21.5])]
    rows = b"".join(np.array([v[k]], t).tobytes() for k in range(2) for _, _, t, v in fields)
    head = [("XTENSION", "'BINTABLE'"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", len(rows) // 2), ("NAXIS2", 2), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", len(fields))]
    head += [x for k, (n, c, _, _) in enumerate(fields) for x in ((f"TTYPE{k + 1}", f"'{n}'"), (f"TFORM{k + 1}", f"'1{c}'"))]
    text = lambda cards: ("".join(f"{k:<8}= {v:>20}".ljust(80) for k, v in cards) + "END".ljust(80)).encode()
    pad = lambda b: b + b" " * (-len(b) % 2880)
    (tmp_path / "a.cat").write_bytes(pad(text([("SIMPLE", "T"), ("BITPIX", 8), ("NAXIS", 0)])) + pad(text(head)) + rows + bytes(-len(rows) % 2880))
    got = sorted(map(tuple, fits.detections(spark, str(tmp_path)).collect()))
    assert got == [(1, 1.5, 3.0, 210.0, 54.0, None), (2, 2.5, 4.0, 211.0, 55.0, 21.5)] and math.isfinite(got[1][5])


def test_entry_without_what_the_training_data_queries_need():
    root = str(Path(__file__).resolve().parents[1])
    code = f"import sys; sys.path.insert(0, {root!r}); sys.modules['astroloom.llm.common'] = None; import __spark_entry__ as e; print(len(e.queries()), 'op1_packing' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[-2]) > 60 and out[-1] == "False"
