"""Queries on compensated sums and global row numbers, with SQL twins in decimals and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranks, statistics
from .pixels import PT, _rounded, points


def _lines(spark, sf_dir: str, *cols: str):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*cols)


def compensated_sums(spark, sf_dir):
    """Prices between numbers of twenty digits that cancel each other, each third of the numbers from tasks of its own: no row moves, a task reads its split of the file."""
    key = ["l_returnflag", "l_linestatus"]
    li = _lines(spark, sf_dir, *key, "l_partkey", "l_extendedprice", "l_discount")
    big, none = F.col("l_partkey") * F.lit(1e17), F.lit(None).cast("double")
    price, discount = (F.col(c).cast("double") for c in ("l_extendedprice", "l_discount"))
    thirds = [li.select(*key, v.alias("v"), d.alias("d")) for v, d in ((big, none), (price, discount), (-big, none))]
    rows = thirds[0].unionAll(thirds[1]).unionAll(thirds[2])
    return statistics.compensated_sums(rows, key, ["v", "d"]).select(*key, F.round("v", 2).alias("price"), F.round("d", 2).alias("discount"))


COMPENSATED_SUMS = """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS price, CAST(sum(CAST(l_discount AS DECIMAL(18, 2))) AS DOUBLE) AS discount
FROM lineitem GROUP BY 1, 2"""


def compensated_mean_std(spark, sf_dir):
    return _rounded(statistics.compensated_mean_std(statistics.pixel_stats(points(spark, sf_dir), ["vec_id", "band"]), ["band"]))


def compensated_survey(spark, sf_dir):
    """All bands together."""
    return _rounded(statistics.compensated_mean_std(statistics.pixel_stats(points(spark, sf_dir), ["vec_id", "band"])))


_DECIMAL = "CAST(v AS DECIMAL(38, 18))"
COMPENSATED_MEAN_STD = f"WITH {PT} SELECT band, count(*) AS n, round(CAST(sum({_DECIMAL}) AS DOUBLE) / count(*), 6) AS mean, round(stddev_pop(v), 6) AS std FROM pt GROUP BY 1"
COMPENSATED_SURVEY = f"WITH {PT} SELECT count(*) AS n, round(CAST(sum({_DECIMAL}) AS DOUBLE) / count(*), 6) AS mean, round(stddev_pop(v), 6) AS std FROM pt"


def _orders(spark, sf_dir: str):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")


def balanced_shards(spark, sf_dir):
    return ranks.balanced_shards(_orders(spark, sf_dir), ["o_totalprice", "o_orderkey"], 7)


def exact_batches(spark, sf_dir):
    return ranks.exact_batches(_orders(spark, sf_dir), ["o_totalprice", "o_orderkey"], 1000)


_NUMBER = "row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1"
QUERIES = {f.__name__: f for f in (compensated_sums, compensated_mean_std, compensated_survey, balanced_shards, exact_batches)}
SQL = {
    "compensated_sums": COMPENSATED_SUMS,
    "compensated_mean_std": COMPENSATED_MEAN_STD,
    "compensated_survey": COMPENSATED_SURVEY,
    "balanced_shards": f"SELECT o_orderkey, o_totalprice, CAST(({_NUMBER}) % 7 AS INT) AS rank FROM orders",
    "exact_batches": f"SELECT o_orderkey, o_totalprice, ({_NUMBER}) // 1000 AS batch FROM orders",
}
