"""Upkeep of catalogues: cleaning, upserts, ledgers, shards and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def without_sentinels(value: Column, *sentinels: float) -> Column:
    """Null where the value stands for a missing one."""
    return F.when(~value.isin(*sentinels), value)


def recoded(value: Column, codes: dict) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in codes.items() for x in kv)), value), value)


def in_ranges(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Rows within all ranges, both ends included; the scan gets the filters."""
    for c, (low, high) in ranges.items():
        df = df.where(F.col(c).between(low, high))
    return df


def upsert(master: DataFrame, parts: DataFrame) -> DataFrame:
    """Both together, each row once; nulls and NaN are equal to themselves. Write it beside the master, then swap."""
    return master.unionByName(parts, allowMissingColumns=True).dropDuplicates()


def pending(work: DataFrame, ledger: DataFrame, key: list[str]) -> DataFrame:
    """Work that the ledger doesn't hold."""
    return work.join(ledger.select(*key), key, "left_anti")


def shard(work: DataFrame, key: list[str], world: int, rank: int, seed: int = 0) -> DataFrame:
    """The part of one of `world` readers: by hash of the key, so that shards are disjoint, complete and need no shuffle."""
    return work.where(F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(world)) == rank)


def batches(df: DataFrame, within: list[str], order: list[str], size: int) -> DataFrame:
    """batch from 0, of `size` rows each, within the groups named."""
    n = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    return df.withColumn("batch", F.floor((n - 1) / size).cast("int"))


def head(df: DataFrame, within: list[str], order: list[str], most: int | None) -> DataFrame:
    """The first `most` rows of each group; all for None."""
    if most is None:
        return df
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).where(F.col("_n") <= most).drop("_n")
