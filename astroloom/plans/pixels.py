"""Queries on pixels, with SQL twins: an embedding of 64 numbers is an image of 8 x 8, its label the band."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pixels as px
from ..operators import images, statistics

N = 8
BANDS = ["0", "1", "2", "3", "4"]


def pictures(spark, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return e.select("vec_id", F.col("label").cast("string").alias("band"), F.col("embedding").alias("pix"), F.lit(N).alias("ny"), F.lit(N).alias("nx"))


def points(spark, sf_dir: str) -> DataFrame:
    return statistics.explode_pixels(pictures(spark, sf_dir), ["vec_id", "band"])


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else f.name for f in df.schema))


PT = "pt AS (SELECT vec_id, CAST(label AS VARCHAR) AS band, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"
STATS = """s AS (SELECT vec_id, band, count(v) AS n_valid_pixels, sum(v) AS sum_pixel_values, sum(v * v) AS sum_pixel_values_squared, min(v) AS min, max(v) AS max,
  count(*) FILTER (v = 0) / count(*) AS frac_zeros, kurtosis_pop(v) AS kurtosis FROM pt GROUP BY 1, 2)"""


def _r(cols, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


def pixel_stats(spark, sf_dir):
    return _rounded(statistics.pixel_stats(points(spark, sf_dir), ["vec_id", "band"]))


PIXEL_STATS = f"WITH {PT}, {STATS} SELECT vec_id, band, n_valid_pixels, {_r(statistics.STATS[1:])} FROM s"


def pixel_stats_wide(spark, sf_dir):
    s = statistics.pixel_stats(points(spark, sf_dir), ["vec_id", "band"]).withColumn("tile", F.expr("vec_id div 10"))
    return _rounded(statistics.wide(s, ["tile"], BANDS))


PIXEL_STATS_WIDE = f"""WITH {PT}, {STATS} SELECT vec_id // 10 AS tile, array_to_string(list_sort(list(DISTINCT band)), '') AS bands,
{", ".join(f'max({c}) FILTER (band = {chr(39)}{b}{chr(39)}) AS "{b}_{c}"' if c == "n_valid_pixels" else f'round(max({c}) FILTER (band = {chr(39)}{b}{chr(39)}), 6) AS "{b}_{c}"' for b in BANDS for c in statistics.STATS)} FROM s GROUP BY 1"""


def survey_mean_std(spark, sf_dir):
    s = statistics.pixel_stats(points(spark, sf_dir), ["vec_id", "band"])
    return _rounded(statistics.survey_mean_std(s.where(statistics.usable(kurtosis_bands=("1", "2"), least_kurtosis=-0.5)), ["band"]))


SURVEY_MEAN_STD = f"""WITH {PT}, {STATS}, u AS (SELECT * FROM s WHERE frac_zeros <= 0.02 AND sum_pixel_values <= 2e11 AND (band NOT IN ('1', '2') OR kurtosis >= -0.5))
SELECT band, CAST(sum(n_valid_pixels) AS BIGINT) AS n, round(sum(sum_pixel_values) / sum(n_valid_pixels), 6) AS mean,
round(sqrt((sum(sum_pixel_values_squared) - sum(sum_pixel_values) * sum(sum_pixel_values) / sum(n_valid_pixels)) / sum(n_valid_pixels)), 6) AS std FROM u GROUP BY 1"""


def exact_mean_std(spark, sf_dir):
    return _rounded(statistics.exact_mean_std(statistics.pixel_stats(points(spark, sf_dir), ["vec_id", "band"]), ["band"]))


EXACT_MEAN_STD = f"WITH {PT} SELECT band, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM pt GROUP BY 1"


def kahan_sums(spark, sf_dir):
    return pictures(spark, sf_dir).select("vec_id", F.round(statistics.kahan(px.good(F.col("pix"))), 6).alias("total"))


def image_description(spark, sf_dir):
    return _rounded(statistics.describe(points(spark, sf_dir), ["vec_id"]))


IMAGE_DESCRIPTION = f"""WITH {PT}, m AS (SELECT vec_id, avg(v) AS a FROM pt GROUP BY 1)
SELECT vec_id, round(any_value(a), 6) AS mean, round(median(v), 6) AS median, round(stddev_pop(v), 6) AS std, round(var_pop(v), 6) AS var,
round(avg((v - a) ** 3) / var_pop(v) ** 1.5, 6) AS skew, round(kurtosis_pop(v), 6) AS kurtosis FROM pt JOIN m USING (vec_id) GROUP BY 1"""


def image_percentiles(spark, sf_dir):
    p = statistics.percentiles(points(spark, sf_dir), ["vec_id"], [0.02, 0.5, 0.998])
    return p.select("vec_id", *(F.round(F.get("p", F.lit(k)), 6).alias(n) for k, n in enumerate(("low", "mid", "high"))))


def percentile_for(spark, sf_dir):
    return statistics.percentile_for(points(spark, sf_dir), ["vec_id"], 0.1, 1.0)


PERCENTILE_FOR = f"""WITH {PT}, q AS (SELECT vec_id, quantile_cont(v, [{", ".join(str(k / 100) for k in range(100, 0, -1))}]) AS p FROM pt GROUP BY 1)
SELECT vec_id, coalesce(100.0::DOUBLE - (list_filter(range(0, 100), lambda i: p[i + 1] <= 0.1)[1]), 100.0::DOUBLE) AS percentile FROM q"""


def pixel_histogram(spark, sf_dir):
    return statistics.histogram(points(spark, sf_dir), "v", -1.0, 1.0, 10)


PIXEL_HISTOGRAM = f"WITH {PT} SELECT CAST(least(floor((v + 1.0) / 2.0 * 10) + 1, 10) AS INT) AS bin, count(*) AS n FROM pt WHERE v BETWEEN -1 AND 1 GROUP BY 1"


# ---- cutouts --------------------------------------------------------------------------------

SIZE = 4


def _objects(pics: DataFrame) -> DataFrame:
    return pics.select("vec_id", (F.col("vec_id") % 8 + 0.3).alias("x"), (F.col("vec_id") * 3 % 8 + 0.5).alias("y"))


def _exploded(df: DataFrame, *key: str) -> DataFrame:
    return df.select(*key, F.posexplode("pix").alias("i", "v")).withColumn("v", F.col("v").cast("double"))


def cutout_fast(spark, sf_dir):
    pics = pictures(spark, sf_dir)
    cut = images.cutouts(_objects(pics), images.to_blocks(pics, ["vec_id"], 3), ["vec_id"], ["vec_id"], SIZE, 3)
    return _exploded(cut, "vec_id")


def cutout_validated(spark, sf_dir):
    gone = F.transform("pix", lambda v: F.when(v < -1, F.lit(float("nan"))).otherwise(v).cast("float"))
    pics = pictures(spark, sf_dir).withColumn("pix", gone)
    cut = images.cutouts(_objects(pics), images.to_blocks(pics, ["vec_id"], 3), ["vec_id"], ["vec_id"], SIZE, 3, start="ceil")
    return _exploded(cut.withColumn("pix", images.validated(F.col("pix"), SIZE, 0.1)), "vec_id")


def _cut_sql(y0: str, x0: str) -> str:
    return f"""o AS (SELECT vec_id, embedding AS e, CAST({y0} AS INT) AS y0, CAST({x0} AS INT) AS x0 FROM embeddings),
c AS (SELECT vec_id, CAST(i AS INT) AS i, CASE WHEN y0 + i // 4 BETWEEN 0 AND 7 AND x0 + i % 4 BETWEEN 0 AND 7 THEN CAST(e[(y0 + i // 4) * 8 + x0 + i % 4 + 1] AS DOUBLE) ELSE 0.0 END AS v FROM o, range(16) t(i))"""


CUTOUT_FAST = f"WITH {_cut_sql('floor(vec_id * 3 % 8 + 0.5 + 0.5) - 2', 'floor(vec_id % 8 + 0.3 + 0.5) - 2')} SELECT vec_id, i, v FROM c"
CUTOUT_VALIDATED = f"""WITH {_cut_sql("ceil(vec_id * 3 % 8 + 0.5 - 2)", "ceil(vec_id % 8 + 0.3 - 2)")}
SELECT vec_id, i, CASE WHEN count(*) FILTER (v < -1) OVER w >= 1.6 OR v < -1 THEN 0.0 ELSE v END AS v FROM c WINDOW w AS (PARTITION BY vec_id)"""


def _stacked(spark, sf_dir, compact: bool) -> DataFrame:
    cut = pictures(spark, sf_dir).select(F.expr("vec_id div 10").alias("obj"), F.get(F.array(*(F.lit(b) for b in "ugriz")), (F.col("vec_id") % 10).cast("int")).alias("band"), "pix").where("band IS NOT NULL AND (obj + ascii(band)) % 3 <> 0")
    out = images.stacks(cut, ["obj"], list("ugriz"), N * N, compact) if compact else images.stacks(cut, ["obj"], list("ugriz"), N, compact)
    total = F.aggregate(F.col("img"), F.lit(0.0), lambda a, v: a + v)
    return out.select("obj", F.posexplode("images").alias("axis", "img")).select("obj", "axis", F.round(total, 5).alias("total"))


def band_stacks(spark, sf_dir):
    return _stacked(spark, sf_dir, False)


def band_stacks_compact(spark, sf_dir):
    return _stacked(spark, sf_dir, True)


_ST = "b AS (SELECT vec_id // 10 AS obj, CAST(vec_id % 10 AS INT) AS k, list_sum(CAST(embedding AS DOUBLE[])) AS t FROM embeddings WHERE vec_id % 10 < 5 AND (vec_id // 10 + ascii('ugriz'[vec_id % 10 + 1])) % 3 <> 0)"
BAND_STACKS = f"WITH {_ST}, o AS (SELECT DISTINCT obj FROM b) SELECT o.obj, CAST(a AS INT) AS axis, coalesce(round(t, 5), 0.0) AS total FROM o CROSS JOIN range(5) r(a) LEFT JOIN b ON b.obj = o.obj AND b.k = a"
BAND_STACKS_COMPACT = f"WITH {_ST} SELECT obj, CAST(row_number() OVER (PARTITION BY obj ORDER BY k) - 1 AS INT) AS axis, round(t, 5) AS total FROM b"


# ---- pixels within the row ------------------------------------------------------------------


def stretches(spark, sf_dir):
    p = F.col("pix")
    cols = {"unit": px.min_max(p), "root": px.root_stretch(p), "asinh": px.asinh_stretch(p), "z": px.z_scaled(p), "gain": px.gains(px.min_max(p), 1.5), "shown": px.for_display(p, -0.5, 0.5)}
    e = pictures(spark, sf_dir).select("vec_id", F.posexplode(F.arrays_zip(*(c.alias(n) for n, c in cols.items()))).alias("i", "s"))
    return e.select("vec_id", "i", *(F.round(F.col(f"s.{n}").cast("double"), 5).alias(n) for n in cols))


STRETCHES = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS p FROM embeddings),
m AS (SELECT vec_id, list_min(p) AS lo, list_max(p) AS hi, list_avg(p) AS a, list_stddev_pop(p) AS s, CAST(unnest(range(64)) AS INT) AS i, unnest(p) AS v FROM e),
u AS (SELECT *, (v - lo) / nullif(hi - lo, 0) AS u FROM m)
SELECT vec_id, i, round(u, 5) AS unit, round(sqrt(u), 5) AS root, round(asinh(u / 0.4) / asinh(1 / 0.4), 5) AS asinh, round((v - a) / (s + 1e-6), 5) AS z,
round(greatest(0.0, least(1.0, u * 1.5)), 5) AS gain, round(CASE WHEN v = 0 OR v < -0.5 THEN 1e-10 WHEN v > 0.5 THEN hi ELSE v END, 5) AS shown FROM u"""

QUERIES = {f.__name__: f for f in (pixel_stats, pixel_stats_wide, survey_mean_std, exact_mean_std, kahan_sums, image_description, image_percentiles, percentile_for, pixel_histogram, cutout_fast, cutout_validated, band_stacks, band_stacks_compact, stretches)}
SQL = {
    "pixel_stats": PIXEL_STATS, "pixel_stats_wide": PIXEL_STATS_WIDE, "survey_mean_std": SURVEY_MEAN_STD, "exact_mean_std": EXACT_MEAN_STD,
    "kahan_sums": "SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings",
    "image_description": IMAGE_DESCRIPTION,
    "image_percentiles": f"WITH {PT} SELECT vec_id, round(quantile_cont(v, 0.02), 6) AS low, round(quantile_cont(v, 0.5), 6) AS mid, round(quantile_cont(v, 0.998), 6) AS high FROM pt GROUP BY 1",
    "percentile_for": PERCENTILE_FOR, "pixel_histogram": PIXEL_HISTOGRAM, "cutout_fast": CUTOUT_FAST, "cutout_validated": CUTOUT_VALIDATED,
    "band_stacks": BAND_STACKS, "band_stacks_compact": BAND_STACKS_COMPACT, "stretches": STRETCHES,
}
