"""Queries on derived columns, files of tiles, sinks and images, with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import scratch
from ..functions import names, sky
from ..functions import pixels as px
from ..operators import anomalies, derived
from ..sinks import fits as fits_sink
from ..sinks import logged, tables
from ..sources import fits
from .pixels import pictures
from .sky import GRID, OBJ, grid, objects


def _read(spark, sf_dir: str, table: str, *cols: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def name_centres(spark, sf_dir):
    x, y = (F.pmod(F.col("l_partkey") * k, F.lit(300)).cast("int") for k in (7, 13))
    rows = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").select("l_orderkey", "l_linenumber", names.tile_file(x, y, "PSS.DR4", ".i.fits", ".", 3).alias("name"))
    ra, dec = derived.centre_of_name(F.col("name"))
    return rows.select("l_orderkey", "l_linenumber", ra.alias("ra"), dec.alias("dec"))


NAME_CENTRES = """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey * 7 % 300 AS x, l_partkey * 13 % 300 AS y FROM lineitem)
SELECT l_orderkey, l_linenumber, round((x / 2.0::DOUBLE) / cos(radians(y / 2.0::DOUBLE - 90)), 6) AS ra, round(y / 2.0::DOUBLE - 90, 6) AS dec FROM t"""


def reference_pixels(spark, sf_dir):
    return _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").select("l_orderkey", "l_linenumber", F.round(derived.moved_reference(F.col("l_quantity")), 6).alias("crpix"))


def known_flags(spark, sf_dir):
    c, o = _read(spark, sf_dir, "customer", "c_custkey"), _read(spark, sf_dir, "orders", "o_custkey", "o_totalprice")
    a, b = (o.where(w).select(F.col("o_custkey").alias("c_custkey")) for w in ("o_totalprice > 250000", "o_totalprice < 5000"))
    return derived.flagged(c, "c_custkey", a, b)


def done_flags(spark, sf_dir):
    x, y = sky.tile_numbers(F.col("ra"), F.col("dec"))
    o = objects(spark, sf_dir).select("ID", sky.tile_name(x, y).alias("tile"), (F.col("ID") % 3 == 0).cast("int").alias("cutout"))
    done = grid(spark, sf_dir).where("band = 'u'").select(sky.tile_name(F.col("xxx"), F.col("yyy")).alias("tile"))
    return derived.marked_done(o, done)


DONE_FLAGS = f"""
WITH {OBJ}, {GRID}, o AS (SELECT ID, '(' || CAST(trunc(ra * 2 * cos(radians(dec))) AS INT) || ', ' || CAST(trunc((dec + 90) * 2) AS INT) || ')' AS tile FROM obj),
d AS (SELECT DISTINCT '(' || xxx || ', ' || yyy || ')' AS tile FROM grid WHERE band = 'u')
SELECT ID, tile, CAST(CASE WHEN tile IN (SELECT tile FROM d) OR ID % 3 = 0 THEN 1 ELSE 0 END AS INT) AS cutout FROM o"""


def tile_slice(spark, sf_dir):
    return derived.part_of_list(grid(spark, sf_dir).select("xxx", "yyy").distinct(), ["xxx", "yyy"], 100, 150)


def size_summary(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem", "l_quantity", "l_linenumber").select((F.col("l_quantity") - 5).alias("re"), F.col("l_linenumber").alias("n_bands"))
    return derived.sizes(li, 0.186).select(F.round("median", 6).alias("median"), F.round("mean", 6).alias("mean"), "n")


def files_of_tiles(spark, sf_dir):
    e = _read(spark, sf_dir, "events", "event_id", "user_id")
    name = F.when(F.col("event_id") % 11 == 0, F.lit("notes.txt")).otherwise(F.concat(F.col("user_id").cast("string"), F.lit("_"), (F.col("user_id") % 7).cast("string"), F.lit("_"), F.col("event_id").cast("string"), F.lit(".h5")))
    return derived.files_by_tile(e.select(name.alias("name"))).select("xxx", "yyy", F.array_join("files", ";").alias("files"))


FILES_OF_TILES = """
SELECT CAST(user_id AS INT) AS xxx, CAST(user_id % 7 AS INT) AS yyy, string_agg(user_id || '_' || user_id % 7 || '_' || event_id || '.h5', ';' ORDER BY user_id || '_' || user_id % 7 || '_' || event_id || '.h5') AS files
FROM events WHERE event_id % 11 <> 0 GROUP BY 1, 2"""


def tile_accounts(spark, sf_dir):
    status = F.get(F.array(F.lit("made"), F.lit("there"), F.lit("made"), F.lit("failed")), (F.col("o_orderkey") % 4).cast("int"))
    return derived.accounted(_read(spark, sf_dir, "orders", "o_orderkey").select(status.alias("status")))


def percentile_stretches(spark, sf_dir):
    e = pictures(spark, sf_dir).select("vec_id", F.posexplode(px.percentile_stretch(F.col("pix"))).alias("i", "v"))
    return e.select("vec_id", "i", F.round("v", 5).alias("v"))


PERCENTILE_STRETCHES = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS p FROM embeddings), l AS (SELECT vec_id, CAST(unnest(range(64)) AS INT) AS i, unnest(p) AS v FROM e),
q AS (SELECT vec_id, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.98) AS hi FROM l GROUP BY 1)
SELECT vec_id, i, round(asinh(greatest(0.0, least(1.0, (v - lo) / (hi - lo))) / 0.01) / asinh(1 / 0.01), 5) AS v FROM l JOIN q USING (vec_id)"""


def colour_composites(spark, sf_dir):
    """Three channels of 4 x 4 pixels, moved above zero, as shown."""
    p = pictures(spark, sf_dir).select("vec_id", F.lit(12).alias("ny"), F.lit(4).alias("nx"), F.transform(F.slice("pix", 1, 48), lambda v: v + F.lit(10.0).cast("float")).alias("pix"))
    rgb = anomalies.composites(p, ["vec_id"])
    at = lambda i: F.conv(F.hex(F.substring("rgb", i, F.lit(1))), 16, 10).cast("int")
    out = rgb.select("vec_id", "rgb", F.explode(F.sequence(F.lit(0), F.lit(47))).alias("i"))
    return out.select("vec_id", "i", at(F.col("i") + 1).alias("v"))


COLOUR_COMPOSITES = """
WITH c AS (SELECT vec_id, CAST(i % 3 AS INT) AS ch, CAST(i // 3 AS INT) AS pos, CAST(CAST(embedding[(i % 3) * 16 + i // 3 + 1] AS FLOAT) + CAST(10 AS FLOAT) AS DOUBLE) AS v FROM embeddings, range(48) t(i)),
l AS (SELECT vec_id, pos, sum(v ORDER BY ch) / 3 AS light FROM c GROUP BY 1, 2), t AS (SELECT vec_id, quantile_cont(light, 0.998) AS top FROM l GROUP BY 1),
g AS (SELECT vec_id, ch, pos, greatest(0.0, least(255.0, pow(v / top * 255, 0.35::DOUBLE))) AS v FROM c JOIN t USING (vec_id)),
n AS (SELECT vec_id, ch, quantile_cont(v, 0.998) AS top FROM g GROUP BY 1, 2)
SELECT vec_id, pos * 3 + ch AS i, CAST(trunc(greatest(0.0, least(255.0, v / top * 255))) AS INT) AS v FROM g JOIN n USING (vec_id, ch)"""


def stored_cutouts(spark, sf_dir):
    """Two writes by tile, the second of which replaces its tiles alone; then what is stored, as counts of a tile."""
    path = scratch.folder(spark, "cutouts")
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey").select(F.col("c_custkey").alias("ID"), F.col("c_nationkey").cast("int").alias("xxx"), (F.col("c_custkey") % 3).cast("int").alias("yyy"))
    tables.cutouts(c, path, files=2)
    tables.cutouts(c.where("xxx = 3 and ID % 2 = 0"), path)
    return spark.read.parquet(path).groupBy("xxx", "yyy").agg(F.count(F.lit(1)).alias("n"), F.sum("ID").alias("ids"))


STORED_CUTOUTS = """
SELECT CAST(c_nationkey AS INT) AS xxx, CAST(c_custkey % 3 AS INT) AS yyy, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS ids FROM customer
WHERE c_nationkey <> 3 OR c_custkey % 2 = 0 OR c_custkey % 3 NOT IN (SELECT c_custkey % 3 FROM customer WHERE c_nationkey = 3 AND c_custkey % 2 = 0) GROUP BY 1, 2"""


def stored_fits(spark, sf_dir):
    """Embeddings as FITS images of 8 x 8 pixels, a file each; then their positions by the cards and their pixels, read back."""
    path = scratch.folder(spark, "fits")
    e = _read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    side = F.lit(8)
    fits_sink.write(e.select(F.col("vec_id").cast("string").alias("name"), side.alias("ny"), side.alias("nx"), F.col("embedding").alias("pix"), (F.col("vec_id") * 7 % 360 + 0.25).cast("double").alias("ra"), (F.col("vec_id") % 170 - 85).cast("double").alias("dec"), F.col("vec_id").alias("NUMBER")), path)
    card = lambda n, kind: F.element_at("cards", n).cast(kind).alias(n.lower())
    heads = fits.headers(spark, path, 0).select("path", card("NUMBER", "long"), card("CRVAL1", "double"), card("CRVAL2", "double"), card("CRPIX1", "double"))
    pixels = fits.image_blocks(spark, path, 0).select("path", F.posexplode("pix").alias("k", "v"))
    sums = pixels.groupBy("path").agg(F.round(F.sum(F.col("v").cast("double") * (F.col("k") + 1)), 5).alias("weighed"))
    return heads.join(sums, "path").select("number", "crval1", "crval2", "crpix1", "weighed")


STORED_FITS = """
SELECT vec_id AS number, CAST(vec_id * 7 % 360 + 0.25 AS DOUBLE) AS crval1, CAST(vec_id % 170 - 85 AS DOUBLE) AS crval2, CAST(4.5 AS DOUBLE) AS crpix1,
       round(sum(CAST(embedding[k] AS DOUBLE) * k), 5) AS weighed FROM embeddings, range(1, 65) t(k) GROUP BY vec_id"""


def stored_master(spark, sf_dir):
    """A master catalogue that is made and then gets rows, each time as a new version."""
    path = scratch.folder(spark, "master")
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    tables.upsert(c.where("c_custkey % 3 <> 0"), path)
    tables.upsert(c.where("c_custkey % 2 = 0"), path)
    return tables.current(spark, path)


def appended_cutouts(spark, sf_dir):
    path = scratch.folder(spark, "appended")
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    for k in (2, 3, 2):
        tables.append(o.where(f"o_orderkey % {k} = 0"), path, ["o_orderkey"])
    return spark.read.parquet(path)


def logged_cutouts(spark, sf_dir):
    """Three appends and a repeat of the first under its name; keys that two batches have count once, from the earlier."""
    path = scratch.folder(spark, "logged")
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    logged.start(spark, path, "o_orderkey long, o_custkey long, batch string", "o_orderkey")
    for name, where in (("two", "o_orderkey % 2 = 0"), ("three", "o_orderkey % 3 = 0"), ("two", "o_orderkey % 5 = 0"), ("far", "o_orderkey < 0")):
        logged.append(o.where(where).withColumn("batch", F.lit(name)), path, name)
    return logged.read(spark, path)


def appended_statistics(spark, sf_dir):
    path = scratch.folder(spark, "statistics")
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_acctbal")
    for k in range(3):
        tables.statistics(c.where(f"c_custkey % 3 = {k}"), path)
    return spark.read.schema("c_custkey long, c_acctbal double").option("header", True).csv(path)


QUERIES = {f.__name__: f for f in (name_centres, reference_pixels, known_flags, done_flags, tile_slice, size_summary, files_of_tiles, tile_accounts, percentile_stretches, colour_composites, stored_cutouts, stored_fits, stored_master, appended_cutouts, logged_cutouts, appended_statistics)}
SQL = {
    "name_centres": NAME_CENTRES,
    "reference_pixels": "SELECT l_orderkey, l_linenumber, round(l_quantity - 0.5 * 0.25 / 0.186, 6) AS crpix FROM lineitem",
    "known_flags": "SELECT c_custkey, CAST(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000 OR o_totalprice < 5000) THEN 1 ELSE 0 END AS INT) AS known FROM customer",
    "done_flags": DONE_FLAGS,
    "tile_slice": f"WITH {OBJ}, {GRID} SELECT DISTINCT xxx, yyy FROM grid ORDER BY xxx, yyy LIMIT 50 OFFSET 100",
    "size_summary": "SELECT round(median(l_quantity - 5) / 0.186 * 2, 6) AS median, round(avg(l_quantity - 5) / 0.186 * 2, 6) AS mean, count(*) AS n FROM lineitem WHERE l_quantity > 5 AND l_linenumber >= 3",
    "files_of_tiles": FILES_OF_TILES,
    "tile_accounts": "SELECT count(*) AS total, count(*) FILTER (o_orderkey % 2 = 0) AS made, count(*) FILTER (o_orderkey % 4 = 1) AS there, count(*) FILTER (o_orderkey % 4 = 3) AS failed, count(*) FILTER (o_orderkey % 4 = 3) = 0 AS complete FROM orders",
    "percentile_stretches": PERCENTILE_STRETCHES,
    "colour_composites": COLOUR_COMPOSITES,
    "stored_cutouts": STORED_CUTOUTS,
    "stored_fits": STORED_FITS,
    "stored_master": "SELECT DISTINCT c_custkey, c_nationkey FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0",
    "appended_cutouts": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0",
    "logged_cutouts": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'two' ELSE 'three' END AS batch FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0",
    "appended_statistics": "SELECT c_custkey, c_acctbal FROM customer",
}
