"""Queries on the tables of the driver as if they were sky catalogues, with SQL twins.

Objects come from orders, tiles from the grid under every second of them, bands
from events (a tile is a user's day, a band an event type)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names, sky
from ..operators import availability, crossmatch, labels, tiles

ORDER = ["u", "g", "r", "i", "z"]
EVENTS = ["click", "error", "purchase", "signup", "view"]


def _read(spark, sf_dir: str, table: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def objects(spark, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(k.alias("ID"), (F.pmod(k * 7919, F.lit(3600000)) / 10000.0).alias("ra"), (F.pmod(c * 104729 + k * 31, F.lit(1600000)) / 10000.0 - 80).alias("dec"))


def grid(spark, sf_dir: str) -> DataFrame:
    """xxx, yyy, band of the tiles that there are."""
    x, y = sky.tile_numbers(F.col("ra"), F.col("dec"))
    band = F.get(F.array(*(F.lit(b) for b in ORDER)), (F.col("ID") % 5).cast("int"))
    return objects(spark, sf_dir).where(F.col("ID") % 2 == 0).select(x.alias("xxx"), y.alias("yyy"), band.alias("band"))


OBJECTS = "SELECT o_orderkey AS ID, (o_orderkey * 7919 % 3600000) / 10000.0 AS ra, ((o_custkey * 104729 + o_orderkey * 31) % 1600000) / 10000.0 - 80 AS dec FROM orders"
OBJ = f"obj AS (SELECT ID, CAST(ra AS DOUBLE) AS ra, CAST(dec AS DOUBLE) AS dec FROM ({OBJECTS}))"
GRID = "grid AS (SELECT CAST(trunc(ra * 2 * cos(radians(dec))) AS INT) AS xxx, CAST(trunc((dec + 90) * 2) AS INT) AS yyy, ['u','g','r','i','z'][ID % 5 + 1] AS band FROM obj WHERE ID % 2 = 0)"
VEC = "cos(radians({d})) * cos(radians({r})) AS {p}x, cos(radians({d})) * sin(radians({r})) AS {p}y, sin(radians({d})) AS {p}z"


def _vec(prefix: str, ra: str = "ra", dec: str = "dec") -> str:
    return VEC.format(p=prefix, r=ra, d=dec)


def object_tile_bands(spark, sf_dir):
    out = tiles.with_bands(objects(spark, sf_dir), grid(spark, sf_dir), ORDER)
    return out.select("ID", "xxx", "yyy", "tile", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"), "bands", "n_bands")


OBJECT_TILE_BANDS = f"""
WITH {OBJ}, {GRID},
bands AS (SELECT xxx, yyy, array_to_string(list_filter(['u','g','r','i','z'], lambda b: list_contains(list(band), b)), '') AS bands, CAST(count(DISTINCT band) AS INT) AS n_bands FROM grid GROUP BY 1, 2),
t AS (SELECT *, yyy / 2.0::DOUBLE - 90 AS dec0, (xxx / 2.0::DOUBLE) / cos(radians(yyy / 2.0::DOUBLE - 90)) AS ra0 FROM bands),
tv AS (SELECT *, {_vec("t", "ra0", "dec0")} FROM t),
ov AS (SELECT *, {_vec("o")} FROM obj),
near AS (
  SELECT ID, ra, dec, xxx, yyy, ra0, dec0, bands, n_bands, row_number() OVER (PARTITION BY ID ORDER BY (ox-tx)*(ox-tx) + (oy-ty)*(oy-ty) + (oz-tz)*(oz-tz), xxx, yyy) AS k
  FROM ov JOIN tv ON tv.dec0 BETWEEN ov.dec - 0.8 AND ov.dec + 0.8),
p AS (
  SELECT ID, k, xxx, yyy, bands, n_bands, sin(radians(dec0)) * sin(radians(dec)) + cos(radians(dec0)) * cos(radians(dec)) * cos(radians(ra - ra0)) AS f,
         cos(radians(dec)) * sin(radians(ra - ra0)) AS a, cos(radians(dec0)) * sin(radians(dec)) - sin(radians(dec0)) * cos(radians(dec)) * cos(radians(ra - ra0)) AS b
  FROM near WHERE k <= 4),
q AS (SELECT ID, k, xxx, yyy, bands, n_bands, 5000 - degrees(a / f) / {sky.SCALE} AS x, 5000 + degrees(b / f) / {sky.SCALE} AS y FROM p WHERE f > 0),
best AS (SELECT * FROM q WHERE x > 0 AND x < 10000 AND y > 0 AND y < 10000 QUALIFY row_number() OVER (PARTITION BY ID ORDER BY k) = 1)
SELECT obj.ID, xxx, yyy, CASE WHEN xxx IS NOT NULL THEN '(' || xxx || ', ' || yyy || ')' END AS tile, round(x, 2) AS x, round(y, 2) AS y, coalesce(bands, '') AS bands, coalesce(n_bands, 0) AS n_bands
FROM obj LEFT JOIN best USING (ID)"""


def tile_grid(spark, sf_dir):
    x, y = sky.tile_numbers(F.col("ra"), F.col("dec"))
    o = objects(spark, sf_dir).select("ID", x.alias("xxx"), y.alias("yyy"))
    ra0, dec0 = sky.tile_centre(F.col("xxx"), F.col("yyy"))
    return o.select("ID", "xxx", "yyy", F.round(ra0, 6).alias("ra0"), F.round(dec0, 6).alias("dec0"))


TILE_GRID = f"""
WITH {OBJ}, g AS (SELECT ID, CAST(trunc(ra * 2 * cos(radians(dec))) AS INT) AS xxx, CAST(trunc((dec + 90) * 2) AS INT) AS yyy FROM obj)
SELECT ID, xxx, yyy, round((xxx / 2.0::DOUBLE) / cos(radians(yyy / 2.0::DOUBLE - 90)), 6) AS ra0, round(yyy / 2.0::DOUBLE - 90, 6) AS dec0 FROM g"""


# ---- availability ---------------------------------------------------------------------------


def avail(spark, sf_dir: str) -> DataFrame:
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    return _read(spark, sf_dir, "events", "user_id", "ts", "event_type").select(F.col("user_id").alias("xxx"), day.alias("yyy"), F.col("event_type").alias("band"))


AVAIL = "a AS (SELECT DISTINCT user_id AS xxx, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS yyy, event_type AS band FROM events)"
_LIST = "['click','error','purchase','signup','view']"
TILES = f"{AVAIL}, s AS (SELECT xxx, yyy, array_to_string(list_sort(list(band)), '') AS bands, CAST(count(*) AS INT) AS n_bands, list(band) AS l FROM a GROUP BY 1, 2)"


def bands_of_tiles(spark, sf_dir):
    return availability.by_tile(avail(spark, sf_dir), EVENTS).drop("band_list")


def tile_presence(spark, sf_dir):
    return availability.presence(avail(spark, sf_dir), EVENTS)


TILE_PRESENCE = f"WITH {AVAIL} SELECT xxx, yyy, {', '.join(f'''CAST(max(CASE WHEN band = '{b}' THEN 1 ELSE 0 END) AS INT) AS in_{b}''' for b in EVENTS)} FROM a GROUP BY 1, 2"


def tiles_per_band(spark, sf_dir):
    return availability.per_band(avail(spark, sf_dir))


def band_counts(spark, sf_dir):
    return availability.band_counts(avail(spark, sf_dir))


BAND_COUNTS = f"""
WITH {TILES}, c AS (SELECT CAST(n_bands AS BIGINT) AS n_bands, count(*) AS n_tiles FROM s GROUP BY 1)
SELECT n_bands, n_tiles, CAST(sum(n_tiles) OVER (ORDER BY n_bands DESC) AS BIGINT) AS at_least FROM c"""


def band_combinations(spark, sf_dir):
    return availability.in_combinations(avail(spark, sf_dir), EVENTS, "view")


BAND_COMBINATIONS = f"""
WITH {TILES}, m AS (SELECT list_filter({_LIST}, lambda x, i: (b >> (i - 1)) & 1 = 1) AS w FROM range(1, 32) t(b)),
v AS (SELECT w FROM m WHERE list_contains(w, 'view'))
SELECT array_to_string(w, '') AS combination, count(s.xxx) AS n_tiles FROM v LEFT JOIN s ON list_has_all(s.l, v.w) GROUP BY 1"""


def tiles_with_least(spark, sf_dir):
    return availability.with_least(avail(spark, sf_dir), EVENTS, 3)


def tiles_of_band(spark, sf_dir):
    return availability.tiles_of(avail(spark, sf_dir), "purchase")


def survey_tiles(spark, sf_dir):
    a = avail(spark, sf_dir)
    return availability.survey_tiles(a.select("xxx", "yyy").distinct().where("xxx % 3 = 0"), a, EVENTS, 2)


def object_report(spark, sf_dir):
    return availability.report(object_tile_bands(spark, sf_dir), 5)


OBJECT_REPORT = f"SELECT count(*) AS n_objects, count(tile) AS n_tiled, {', '.join(f'count(*) FILTER (n_bands = {k}) AS in_{k}' for k in range(6))} FROM ({OBJECT_TILE_BANDS})"


# ---- cross-match and labels -----------------------------------------------------------------


def detections(spark, sf_dir: str) -> DataFrame:
    x, y = sky.tile_numbers(F.col("ra"), F.col("dec"))
    return objects(spark, sf_dir).select(F.col("ID").alias("det_id"), "ra", "dec", sky.tile_name(x, y).alias("tile"))


def near_labels(spark, sf_dir: str, every: int, step: float) -> DataFrame:
    """Labels beside every n-th detection, up to 29 steps of arc seconds north of it."""
    d = detections(spark, sf_dir).where(F.col("det_id") % every == 0)
    k = F.col("det_id")
    return d.select((k * 2).alias("label_id"), "ra", (F.col("dec") + (k % 30) * step / 3600).alias("dec"), "tile", (k % 3).cast("double").alias("cspec"), (k % 100 / 100.0).alias("zspec"))


DET = f"{OBJ}, det AS (SELECT ID AS det_id, ra, dec, '(' || CAST(trunc(ra * 2 * cos(radians(dec))) AS INT) || ', ' || CAST(trunc((dec + 90) * 2) AS INT) || ')' AS tile FROM obj), dv AS (SELECT det_id, dec AS ddec, tile AS dtile, {_vec('d')} FROM det)"


def _labels_sql(name: str, every: int, step: float) -> str:
    return f"""{name} AS (SELECT det_id * 2 AS label_id, ra, dec + (det_id % 30) * {step}::DOUBLE / 3600 AS dec, tile, CAST(det_id % 3 AS DOUBLE) AS cspec, CAST(det_id % 100 / 100.0 AS DOUBLE) AS zspec FROM det WHERE det_id % {every} = 0)"""


def _match_sql(name: str, labels_: str, sep: float, same: bool = False, each: bool = False) -> str:
    """The nearest detection by a range join on dec; the chord decides."""
    own = "label_id, dtile" if each else "label_id"
    return f"""{name}_v AS (SELECT label_id, dec AS ldec, tile AS ltile, {_vec('l')} FROM {labels_}),
{name}_m AS (SELECT label_id, det_id, dtile, sqrt((lx-dx)*(lx-dx) + (ly-dy)*(ly-dy) + (lz-dz)*(lz-dz)) AS away FROM {name}_v JOIN dv ON ddec BETWEEN ldec - {2 * sep}/3600 AND ldec + {2 * sep}/3600 {"WHERE ltile = dtile" if same else ""}),
{name} AS (SELECT label_id, det_id, degrees(2 * asin(least(1.0, away / 2))) * 3600 AS sep FROM (SELECT * FROM {name}_m QUALIFY row_number() OVER (PARTITION BY {own} ORDER BY away, det_id) = 1) WHERE degrees(2 * asin(least(1.0, away / 2))) * 3600 < {sep})"""


def xmatch_nearest(spark, sf_dir):
    return crossmatch.nearest(near_labels(spark, sf_dir, 10, 0.9), detections(spark, sf_dir), 15.0).select("label_id", "det_id", F.round("sep", 4).alias("sep"))


def xmatch_unmatched(spark, sf_dir):
    lab = near_labels(spark, sf_dir, 10, 0.9)
    return crossmatch.unmatched(lab, crossmatch.nearest(lab, detections(spark, sf_dir), 15.0)).select("label_id", "tile")


def catalog_union(spark, sf_dir):
    out = crossmatch.union_catalogs(near_labels(spark, sf_dir, 10, 0.9).select("ra", "dec", "label_id"), detections(spark, sf_dir))
    return out.select("label_id", "det_id", F.round("ra", 7).alias("ra"))


CATALOG_UNION = f"""
WITH {DET}, {_labels_sql("lab", 10, 0.9)}, {_match_sql("hit", "lab", 15.0)}
SELECT label_id, CAST(NULL AS BIGINT) AS det_id, round(ra, 7) AS ra FROM lab WHERE label_id NOT IN (SELECT label_id FROM hit)
UNION ALL SELECT NULL, det_id, round(ra, 7) FROM det"""


def label_attach(spark, sf_dir):
    det = detections(spark, sf_dir)
    z, lens, dwarf = near_labels(spark, sf_dir, 7, 0.1), near_labels(spark, sf_dir, 11, 0.1), near_labels(spark, sf_dir, 13, 0.7)
    out = labels.attach(det, z, lens.select("label_id", "ra", "dec"), dwarf.select("label_id", "ra", "dec", "tile"))
    return out.select("det_id", "tile", F.round("ra", 7).alias("ra"), "class_label", "zspec", "lens", "lsb")


LABEL_ATTACH = f"""
WITH {DET}, {_labels_sql("zl", 7, 0.1)}, {_labels_sql("ll", 11, 0.1)}, {_labels_sql("wl", 13, 0.7)},
{_match_sql("zm", "zl", 1.0, each=True)}, {_match_sql("lm", "ll", 1.0, each=True)}, {_match_sql("wm", "wl", 10.0, same=True)},
last AS (SELECT det_id, cspec, zspec FROM zm JOIN zl USING (label_id) QUALIFY row_number() OVER (PARTITION BY det_id ORDER BY label_id DESC) = 1)
SELECT det_id, tile, round(ra, 7) AS ra, CASE WHEN det_id IN (SELECT det_id FROM wm) THEN 2.0::DOUBLE ELSE cspec END AS class_label, zspec,
       CASE WHEN det_id IN (SELECT det_id FROM lm) THEN 1.0::DOUBLE END AS lens, CASE WHEN det_id IN (SELECT det_id FROM wm) THEN 1.0::DOUBLE END AS lsb
FROM det LEFT JOIN last USING (det_id)
UNION ALL SELECT NULL, tile, round(ra, 7), 2.0, NULL, NULL, 1.0 FROM wl WHERE label_id NOT IN (SELECT label_id FROM wm)"""


def label_counts(spark, sf_dir):
    return labels.counts(label_attach(spark, sf_dir))


def label_refresh(spark, sf_dir):
    det = detections(spark, sf_dir).withColumns({"zspec": F.lit(0.5).cast("float"), "lens": F.lit(None).cast("float")})
    fresh = objects(spark, sf_dir).where("ID % 5 = 0").select("ra", "dec", F.when(F.col("ID") % 10 == 0, 0.5).otherwise(0.25).alias("zspec"), F.lit(None).cast("double").alias("lens"))
    return labels.refresh(det, fresh, ["zspec", "lens"]).select("det_id", F.col("zspec").cast("double").alias("zspec"), "lens", "changed")


LABEL_REFRESH = f"""
WITH {OBJ}, f AS (SELECT CAST(ra AS FLOAT) AS ra, CAST(dec AS FLOAT) AS dec, max(CASE WHEN ID % 10 = 0 THEN 0.5 ELSE 0.25 END) AS z FROM obj WHERE ID % 5 = 0 GROUP BY 1, 2)
SELECT ID AS det_id, CAST(coalesce(z, 0.5) AS DOUBLE) AS zspec, CAST(NULL AS FLOAT) AS lens, coalesce(z <> 0.5, false) AS changed
FROM obj LEFT JOIN f ON f.ra = CAST(obj.ra AS FLOAT) AND f.dec = CAST(obj.dec AS FLOAT)"""


# ---- names ----------------------------------------------------------------------------------


def tile_files(spark, sf_dir):
    x, y = (F.pmod(F.col("l_partkey") * k, F.lit(1000)).cast("int") for k in (7, 13))
    rows = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").select("l_orderkey", "l_linenumber", x.alias("tx"), y.alias("ty"))
    name = F.when(F.col("l_linenumber") % 2 == 0, names.tile_file(F.col("tx"), F.col("ty"), "PSS.DR4", ".i.fits", ".", 3)).otherwise(names.tile_file(F.col("tx"), F.col("ty"), "calexp-CFIS", ".fits", "_", 3))
    n = rows.withColumn("name", name).withColumn("n", names.numbers_in(F.col("name")))
    return n.select("l_orderkey", "l_linenumber", "name", F.get("n", F.lit(0)).alias("xxx"), F.get("n", F.lit(1)).alias("yyy"))


TILE_FILES = """
WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey * 7 % 1000 AS INT) AS xxx, CAST(l_partkey * 13 % 1000 AS INT) AS yyy FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN format('PSS.DR4.{:03d}.{:03d}.i.fits', xxx, yyy) ELSE format('calexp-CFIS_{:03d}_{:03d}.fits', xxx, yyy) END AS name, xxx, yyy FROM t"""

_NEAR = f"WITH {DET}, {_labels_sql('lab', 10, 0.9)}, {_match_sql('hit', 'lab', 15.0)}"

QUERIES = {f.__name__: f for f in (object_tile_bands, tile_grid, bands_of_tiles, tile_presence, tiles_per_band, band_counts, band_combinations, tiles_with_least, tiles_of_band, survey_tiles, object_report, xmatch_nearest, xmatch_unmatched, catalog_union, label_attach, label_counts, label_refresh, tile_files)}
SQL = {
    "object_tile_bands": OBJECT_TILE_BANDS,
    "tile_grid": TILE_GRID,
    "bands_of_tiles": f"WITH {TILES} SELECT xxx, yyy, bands, n_bands FROM s",
    "tile_presence": TILE_PRESENCE,
    "tiles_per_band": f"WITH {AVAIL} SELECT band, count(*) AS n_tiles FROM a GROUP BY 1",
    "band_counts": BAND_COUNTS,
    "band_combinations": BAND_COMBINATIONS,
    "tiles_with_least": f"WITH {TILES} SELECT xxx, yyy, bands, n_bands FROM s WHERE n_bands >= 3",
    "tiles_of_band": f"WITH {AVAIL} SELECT xxx, yyy FROM a WHERE band = 'purchase'",
    "survey_tiles": f"WITH {TILES} SELECT xxx, yyy FROM s WHERE n_bands >= 2 AND xxx % 3 = 0",
    "object_report": OBJECT_REPORT,
    "xmatch_nearest": f"{_NEAR} SELECT label_id, det_id, round(sep, 4) AS sep FROM hit",
    "xmatch_unmatched": f"{_NEAR} SELECT label_id, tile FROM lab WHERE label_id NOT IN (SELECT label_id FROM hit)",
    "catalog_union": CATALOG_UNION,
    "label_attach": LABEL_ATTACH,
    "label_counts": f"SELECT count(class_label) AS n_class_label, count(zspec) AS n_zspec, count(lens) AS n_lens, count(lsb) AS n_lsb FROM ({LABEL_ATTACH})",
    "label_refresh": LABEL_REFRESH,
    "tile_files": TILE_FILES,
}
