"""Mixing sources to target weights, as a curriculum whose weights change over training.

Each source has a schedule: weights at equally spaced times from the start to the end of training, linear in between. The
integral of the schedule is the source's weight in the whole mix; weights share a budget of words, no source gets more than
`repeats` times its words, and what a full source can't take is shared anew among the others by weight. That is done in one step: sources
in the order of their bound over their weight fill up first, and a running sum tells what level the rest reaches.

A source's documents form a stream in the order of a hash of their ids, again and again. A document's copy starts where the stream has
some number of words; the time at which the source's cumulative demand (its target times the integral of its schedule up
to then) reaches that number is the copy's training position. The range-sorted positions are the order of training.

Running sums don't meet in one task: documents are dealt to buckets by the leading part of their hash, buckets are summed,
and a document adds the sum of its source's earlier buckets to the running sum in its own. A source with a third of all rows is as many
buckets as the others together. Everything is DataFrame operations.

Defined results: a null text has no words; documents without words and those beyond a source's target take none and have no position;
a null source is a source of its own, the last; null ids and repeated rows are documents like others (rows alike in all columns are interchangeable);
an empty table gives an empty result; columns other than doc_id, text and source are not read. Very long texts are counted whole;
the copy that reaches the target is cut there, so that sources meet their targets to a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, partitions, read

#: Rows of all sources that share one bucket of the running sum, about, where there are more buckets than partitions.
BUCKET_ROWS = 100_000
#: Leading hexadecimal digits of the hash that order documents; 60 bits.
DIGITS = 15


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size (words of the whole text) and order, a hash of the id; all that later steps read."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"), F.conv(F.substring(key, 1, DIGITS), 16, 10).cast("long").alias("order"))


def area(weights: Column) -> Column:
    """The integral over training of a schedule of two weights or more, linear between them; training lasts 1."""
    n = F.size(weights) - 1
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda s, k: s + (F.get(weights, k - 1) + F.get(weights, k)) / 2) / n


def time_of(share: Column, weights: Column, whole: Column) -> Column:
    """When a schedule's integral reaches that share (0 to 1) of its whole: the piece that holds it, then the root of its quadratic."""
    n = F.size(weights) - 1
    want = share * whole * n
    start = F.struct(F.lit(0.0).alias("before"), F.lit(None).cast("double").alias("at"))

    def step(s, k):
        a, b = F.get(weights, k - 1), F.get(weights, k)
        end = s.before + (a + b) / 2
        rest = want - s.before
        inside = F.when(a == b, F.try_divide(rest, a)).otherwise(F.try_divide(F.sqrt(F.greatest(F.lit(0.0), a * a + 2 * (b - a) * rest)) - a, b - a))
        here = s["at"].isNull() & ((rest <= end - s.before) | (k == n)) & (a + b > 0)
        return F.struct(end.alias("before"), F.when(here, (k - 1 + F.least(F.lit(1.0), inside)) / n).otherwise(s["at"]).alias("at"))

    return F.aggregate(F.sequence(F.lit(1), n), start, step)["at"]


def targets(schedules: DataFrame, share: float, repeats: int) -> DataFrame:
    """schedules (source, source_size, weights) plus weight, its integral, and target, the words that the source gives to the mix.

    Sources fill in the order of bound over weight: the first whose bound is above the level of those still open is open, and so are all later ones."""
    bound = (F.col("source_size") * repeats).cast("double")
    df = schedules.withColumn("weight", area(F.col("weights"))).withColumn("_bound", bound)
    df = df.withColumn("_ratio", F.when(F.col("weight") > 0, F.col("_bound") / F.col("weight")).otherwise(F.lit(float("inf"))))
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())  # one row for each source
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) * F.lit(share) - F.coalesce(F.sum("_bound").over(before), F.lit(0.0))
    df = df.withColumn("_level", F.when(F.col("weight") > 0, left / F.sum("weight").over(after)))
    open_ = F.min(F.when(F.col("_ratio") > F.col("_level"), F.struct("_ratio", "_level"))).over(Window.partitionBy())
    df = df.withColumn("_open", open_["_level"])
    target = F.when(F.col("weight") > 0, F.least(F.col("_bound"), F.coalesce(F.col("_open") * F.col("weight"), F.col("_bound")))).otherwise(F.lit(0.0))
    return df.select("source", "source_size", "weights", "weight", target.alias("target"))


def placed(sized: DataFrame, goals: DataFrame, repeats: int, buckets: int) -> DataFrame:
    """sized plus source_size, target and copies: what each pass over the source takes of the document, with its training position (0 to 1)."""
    dealt = sized.withColumn("_b", F.expr(f"order div {(1 << 4 * DIGITS) // buckets + 1}L"))
    earlier = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("source", "_b").agg(F.sum("size").alias("_n")).select(F.col("source").alias("_of"), F.col("_b").alias("_at"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source", "_b").orderBy("order", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("_own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    df = dealt.join(starts, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_b") == F.col("_at")))
    df = df.join(goals.withColumnRenamed("source", "_goal"), F.col("source").eqNullSafe(F.col("_goal")))
    words = F.floor(F.col("target") + 0.5)

    def copy(k):
        offset = k.cast("long") * F.col("source_size") + F.col("_start") + F.col("_own")
        return F.struct(
            k.alias("copy"),
            F.greatest(F.lit(0), F.least(F.col("size"), words - offset)).alias("words"),
            time_of(F.try_divide(offset, F.col("target")), F.col("weights"), F.col("weight")).alias("position"),
        )

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), copy), lambda c: c.words > 0)
    return df.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, schedule, share: float = 1.5, repeats: int = 2, seed: int = 2024) -> DataFrame:
    """Every document with source_size, target, taken and copies (copy, words, position), in the order of its first training position.

    schedule: maps a table of sources (source, source_size) to the same with weights, an array of at least two weights that aren't negative.
    share: the budget as a share of all words. repeats: passes over a source at most."""
    sized = materialise(sizes(docs, seed), "mix_sizes")
    goals = materialise(targets(schedule(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), share, repeats), "mix_targets")
    buckets = max(partitions(docs.sparkSession), sized.count() // BUCKET_ROWS)
    df = materialise(placed(sized, goals, repeats, buckets), "mix_placed")
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda s, c: s + c.words)
    out = df.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "copies").orderBy(F.get("copies", F.lit(0))["position"].asc_nulls_last(), F.col("doc_id").asc_nulls_last())
    out = materialise(out, "mix")
    for table in (sized, goals, df):
        discard(table)
    return out


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each copy, range-sorted by position: doc_id, copy, words, position."""
    rows = mixed.select("doc_id", F.explode("copies").alias("c")).select("doc_id", "c.*")
    return rows.orderBy("position", F.col("doc_id").asc_nulls_last(), "copy")


def cycling(weights: list[float], early: list[float]):
    """A schedule for sources in the order of code points, null last: weights in turn, moving linearly from early[k] of the weight to 2 - early[k] of it."""

    def schedule(sources: DataFrame) -> DataFrame:
        turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)  # one row for each source
        pick = F.array(*(F.array(F.lit(w * e), F.lit(w * (2 - e))) for w, e in zip(weights, early, strict=True)))
        return sources.select("source", "source_size", F.get(pick, turn).alias("weights"))

    return schedule


def op12_mixing(spark, sf_dir) -> DataFrame:
    """Sources of weight 5 come early, those of weight 1 late."""
    out = mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"), cycling([5.0, 2.0, 1.0], [1.5, 1.0, 0.5]))
    at = lambda k: F.round(F.get(F.col("copies"), F.lit(k))["position"], 6)
    return out.select("doc_id", "size", "source_size", "target", "taken", at(0).alias("first_position"), at(1).alias("second_position"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS ord
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM d GROUP BY source),
w AS (
  SELECT source, source_size, CASE turn WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         CASE turn WHEN 0 THEN 7.5::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS a, CASE turn WHEN 0 THEN 2.5::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.5::DOUBLE END AS b,
         source_size * 2.0::DOUBLE AS bound
  FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (
  SELECT source, source_size, a, b, weight, least(bound, coalesce((SELECT arg_min(level, bound / weight) FROM l WHERE bound / weight > level) * weight, bound)) AS target FROM l),
c AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
k AS (
  SELECT c.doc_id, c.size, t.source_size, t.target, a, b, weight, e, CAST(e * t.source_size + before AS BIGINT) AS off,
         CAST(greatest(0, least(size, floor(target + 0.5) - (e * t.source_size + before))) AS BIGINT) AS words
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source, range(2) r(e)),
p AS (
  SELECT *, CASE WHEN words = 0 THEN NULL WHEN a = b THEN off / target * weight / a ELSE (sqrt(greatest(0.0, a * a + 2 * (b - a) * (off / target * weight))) - a) / (b - a) END AS pos FROM k)
SELECT doc_id, size, source_size, any_value(target) AS target, CAST(sum(words) AS BIGINT) AS taken, round(min(pos), 6) AS first_position, round(max(pos) FILTER (e = 1 AND off >= source_size), 6) AS second_position
FROM p GROUP BY doc_id, size, source_size
"""
