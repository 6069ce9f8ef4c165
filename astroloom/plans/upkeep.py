"""Queries on the upkeep of catalogues, with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sky
from ..operators import catalogs


def _read(spark, sf_dir: str, table: str, *cols: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def range_scan(spark, sf_dir):
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return catalogs.in_ranges(o, {"o_custkey": (100, 900), "o_totalprice": (1000.0, 200000.0)})


def sentinel_clean(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    return li.withColumn("l_quantity", catalogs.without_sentinels(F.col("l_quantity"), 1.0, 50.0))


def recoded_status(spark, sf_dir):
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    return o.withColumn("o_orderstatus", catalogs.recoded(F.col("o_orderstatus"), {"F": "done", "O": "open"}))


def flux_rescaled(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    return li.select("l_orderkey", "l_linenumber", F.round(sky.rescaled(F.col("l_extendedprice"), F.lit(27.0), F.lit(30.0)), 2).alias("flux"))


def master_upsert(spark, sf_dir):
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    return catalogs.upsert(c.where("c_custkey % 3 <> 0"), c.where("c_custkey % 2 = 0"))


def ledger_pending(spark, sf_dir):
    e = _read(spark, sf_dir, "events", "user_id", "event_type")
    return catalogs.pending(e.select("user_id").distinct(), e.where("event_type = 'error' AND user_id % 2 = 0"), ["user_id"])


def batch_numbers(spark, sf_dir):
    return catalogs.batches(_read(spark, sf_dir, "events", "event_id", "user_id"), ["user_id"], ["event_id"], 7)


def head_per_tile(spark, sf_dir):
    return catalogs.head(_read(spark, sf_dir, "events", "event_id", "user_id"), ["user_id"], ["event_id"], 5)


def all_shards(spark, sf_dir):
    """How often each event stands in the four shards: once."""
    e = _read(spark, sf_dir, "events", "event_id")
    parts = [catalogs.shard(e, ["event_id"], 4, k) for k in range(4)]
    whole = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    return whole.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (range_scan, sentinel_clean, recoded_status, flux_rescaled, master_upsert, ledger_pending, batch_numbers, head_per_tile, all_shards)}
SQL = {
    "range_scan": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey BETWEEN 100 AND 900 AND o_totalprice BETWEEN 1000 AND 200000",
    "sentinel_clean": "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity NOT IN (1, 50) THEN l_quantity END AS l_quantity FROM lineitem",
    "recoded_status": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders",
    "flux_rescaled": "SELECT l_orderkey, l_linenumber, round(l_extendedprice * pow(10.0::DOUBLE, 1.2::DOUBLE), 2) AS flux FROM lineitem",
    "master_upsert": "SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 3 <> 0 UNION SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0",
    "ledger_pending": "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND user_id % 2 = 0)",
    "batch_numbers": "SELECT event_id, user_id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 7 AS INT) AS batch FROM events",
    "head_per_tile": "SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 5",
    "all_shards": "SELECT event_id, count(*) AS n FROM events GROUP BY 1",
}
