"""Queries on images of many blocks, with SQL twins: 50 embeddings of 8 x 8 pixels are the blocks of an image of 80 x 40."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocks, fourier

SIDE, ROWS, COLS = 8, 10, 5
FLAT, LEAST = 0.05, 3
MESH, SIGMA, ROUNDS = 4, 1.5, 2
ARMS = (1, 16, 10)


def mosaic(spark, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    n = ROWS * COLS
    return e.select(F.expr(f"vec_id div {n}").alias("image"), F.expr(f"CAST(vec_id % {n} div {COLS} AS INT)").alias("by"), (F.col("vec_id") % COLS).cast("int").alias("bx"), F.lit(SIDE).alias("h"), F.lit(SIDE).alias("w"), F.col("embedding").alias("pix"))


def flat_patches(spark, sf_dir):
    """Patches of flat detail that reach across blocks."""
    return blocks.flat_patches(mosaic(spark, sf_dir), ["image"], FLAT, LEAST, SIDE)


_COEFFICIENTS = """p AS (
  SELECT vec_id // 50 AS image, CAST(vec_id % 50 // 5 * 4 + i // 4 AS INT) AS y, CAST(vec_id % 5 * 4 + i % 4 AS INT) AS x, CAST(embedding AS DOUBLE[]) AS e, i // 4 * 16 + i % 4 * 2 + 1 AS k
  FROM embeddings, range(16) t(i)),
c AS (SELECT image, y, x, e[k] AS a, e[k + 1] AS b, e[k + 8] AS c, e[k + 9] AS d FROM p)"""

FLAT_PATCHES = f"""
WITH RECURSIVE {_COEFFICIENTS},
f AS MATERIALIZED (
  SELECT image, 'diagonal' AS kind, y, x FROM c WHERE abs((a - b - c + d) / 2) <= {FLAT} UNION ALL
  SELECT image, 'horizontal', y, x FROM c WHERE abs((a + b - c - d) / 2) <= {FLAT} UNION ALL
  SELECT image, 'vertical', y, x FROM c WHERE abs((a - b + c - d) / 2) <= {FLAT}),
r AS (
  SELECT image, kind, y, x, y AS ry, x AS rx FROM f UNION
  SELECT r.image, r.kind, r.y, r.x, f.y, f.x FROM r, (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) o(dy, dx), f
  WHERE f.image = r.image AND f.kind = r.kind AND f.y = r.ry + dy AND f.x = r.rx + dx),
m AS (SELECT image, kind, y, x, min(ry * 100000::BIGINT + rx) AS first FROM r GROUP BY image, kind, y, x)
SELECT image, kind, CAST(first // 100000 AS INT) AS y, CAST(first % 100000 AS INT) AS x, count(*) AS size FROM m GROUP BY image, kind, first HAVING count(*) >= {LEAST}"""


def flat_images(spark, sf_dir):
    """Which details of an image have a flat patch of twelve coefficients or more."""
    return blocks.haar_anomalies(mosaic(spark, sf_dir), ["image"], FLAT, 12, SIDE)


FLAT_IMAGES = f"SELECT image, bool_or(kind = 'diagonal') AS diagonal, bool_or(kind = 'horizontal') AS horizontal, bool_or(kind = 'vertical') AS vertical FROM ({FLAT_PATCHES}) WHERE size >= 12 GROUP BY image"


def mesh_background(spark, sf_dir):
    """Clipped level and scatter of mesh squares, smoothed over their neighbours in other blocks too."""
    squares = blocks.mesh_squares(mosaic(spark, sf_dir), ["image"], MESH, SIGMA, ROUNDS, SIDE)
    return blocks.smooth_squares(squares, ["image"]).select("image", "my", "mx", F.round("level", 6).alias("level"), F.round("rms", 6).alias("rms"))


def _clipped(was: str, now: str) -> str:
    return f"""{now}m AS (SELECT image, my, mx, median(v) AS mid, stddev_pop(v) AS sd FROM {was} GROUP BY image, my, mx),
{now} AS (SELECT {was}.* FROM {was} JOIN {now}m USING (image, my, mx) WHERE abs(v - mid) <= {SIGMA} * sd)"""


MESH_BACKGROUND = f"""
WITH v0 AS (SELECT vec_id // 50 AS image, CAST(vec_id % 50 // 5 * 2 + i // 32 AS INT) AS my, CAST(vec_id % 5 * 2 + i % 8 // 4 AS INT) AS mx, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(64) t(i)),
{_clipped("v0", "v1")}, {_clipped("v1", "v2")},
s AS (SELECT image, my, mx, avg(v) AS mean, median(v) AS mid, stddev_pop(v) AS rms FROM v2 GROUP BY image, my, mx),
l AS (SELECT image, my, mx, CASE WHEN rms = 0 OR abs(mean - mid) < 0.3 * rms THEN 2.5 * mid - 1.5 * mean ELSE mid END AS level, rms FROM s)
SELECT a.image, a.my, a.mx, round(median(b.level), 6) AS level, round(median(b.rms), 6) AS rms
FROM l a JOIN l b ON a.image = b.image AND abs(a.my - b.my) <= 1 AND abs(a.mx - b.mx) <= 1 GROUP BY a.image, a.my, a.mx"""


def tile_spectrum(spark, sf_dir):
    """Magnitudes of the spectrum of each image, its zero frequency in the middle."""
    pieces = fourier.spectra(mosaic(spark, sf_dir), ["image"], log=False, columns=6, block=SIDE)
    each = pieces.select("image", "y", "x", "w", F.posexplode("pix").alias("k", "m"))
    return each.select("image", F.expr("y + k div w").cast("int").alias("y"), F.expr("x + k % w").cast("int").alias("x"), F.round("m", 5).alias("m"))


def fourier_arms(spark, sf_dir):
    """Mean magnitudes over the arms and corners of each image's spectrum."""
    found = fourier.anomalies(mosaic(spark, sf_dir), ["image"], 1.02, arms=ARMS, columns=6, block=SIDE)
    return found.select("image", *(F.round(c, 6).alias(c) for c in ("vertical", "horizontal", "corners")), "anomaly")


_SPECTRUM = """
p AS (SELECT vec_id // 50 AS image, vec_id % 50 // 5 * 8 + i // 8 AS y, vec_id % 5 * 8 + i % 8 AS x, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(64) t(i)),
s AS (SELECT image, max(y) + 1 AS rows, max(x) + 1 AS cols FROM p GROUP BY image),
r AS (SELECT image, y, k, sum(v * cos(2 * pi() * x * k / cols)) AS re, -sum(v * sin(2 * pi() * x * k / cols)) AS im FROM p JOIN s USING (image), range(40) f(k) WHERE k < cols GROUP BY image, y, k),
c AS (SELECT image, j, k, sum(re * cos(2 * pi() * y * j / rows) + im * sin(2 * pi() * y * j / rows)) AS re, sum(im * cos(2 * pi() * y * j / rows) - re * sin(2 * pi() * y * j / rows)) AS im FROM r JOIN s USING (image), range(80) g(j) WHERE j < rows GROUP BY image, j, k),
m AS (SELECT image, rows, cols, CAST((j + rows // 2) % rows AS INT) AS y, CAST((k + cols // 2) % cols AS INT) AS x, sqrt(re * re + im * im) AS m FROM c JOIN s USING (image))"""

TILE_SPECTRUM = f"WITH {_SPECTRUM} SELECT image, y, x, round(m, 5) AS m FROM m"

_HALF, _LONG, _CORNER = ARMS
FOURIER_ARMS = f"""
WITH {_SPECTRUM},
e(a, b) AS (VALUES (0, 0), (0, 1), (1, 0), (1, 1)),
v AS (SELECT image, avg(m) AS vertical FROM m, range(2) o(a) WHERE abs(x - cols // 2) <= {_HALF} AND CASE WHEN a = 0 THEN y < {_LONG} ELSE y >= rows - {_LONG} END GROUP BY image),
h AS (SELECT image, avg(m) AS horizontal FROM m, range(2) o(a) WHERE abs(y - rows // 2) <= {_HALF} AND CASE WHEN a = 0 THEN x < {_LONG} ELSE x >= cols - {_LONG} END GROUP BY image),
q AS (SELECT image, avg(m) AS corners FROM m, e WHERE CASE WHEN a = 0 THEN y < {_CORNER} ELSE y >= rows - {_CORNER} END AND CASE WHEN b = 0 THEN x < {_CORNER} ELSE x >= cols - {_CORNER} END GROUP BY image)
SELECT image, round(vertical, 6) AS vertical, round(horizontal, 6) AS horizontal, round(corners, 6) AS corners, vertical > 1.02 * corners AND horizontal > 1.02 * corners AS anomaly
FROM v JOIN h USING (image) JOIN q USING (image)"""


QUERIES = {f.__name__: f for f in (flat_patches, flat_images, mesh_background, tile_spectrum, fourier_arms)}
SQL = {"flat_patches": FLAT_PATCHES, "flat_images": FLAT_IMAGES, "mesh_background": MESH_BACKGROUND, "tile_spectrum": TILE_SPECTRUM, "fourier_arms": FOURIER_ARMS}
