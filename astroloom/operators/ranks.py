"""Global row numbers without a task that sees all rows: balanced shards and batches of exact size.

Rows are range-partitioned and sorted within each range; a row's number is its place in its range plus the rows of earlier ranges. The
ranges are written once, as two plans over one sampled partitioning could differ. Only one count for each range meets in a task.

Defined results: nulls come first, as in any ascending order; rows that are equal in all order columns get their numbers in any order, so give
an order without ties where numbers must be the same on every run; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import scratch


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """df plus its row number in that order, from 0."""
    place = F.monotonically_increasing_id()  # the range in the upper bits, the place in it below
    ranged = scratch.written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", place), "ranges")
    split = ranged.withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = split.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return split.join(starts, "_range").withColumn(name, number).drop("_range", "_start", "_at")


def balanced_shards(work: DataFrame, order: list[str], world: int) -> DataFrame:
    """work plus rank, the reader of `world` that each row goes to in turn: sizes differ by one at most."""
    return numbered(work, order, "_number").withColumn("rank", (F.col("_number") % world).cast("int")).drop("_number")


def exact_batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """df plus batch from 0, each of exactly `size` rows but the last."""
    return numbered(df, order, "_number").withColumn("batch", F.expr(f"_number div {int(size)}")).drop("_number")
