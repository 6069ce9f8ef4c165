"""Target-distribution importance resampling: draw the documents that look most like a target, at random in proportion to how much.

Documents become arrays of hashed word runs; a bucket's gain is the logarithm of its share in the target over its share in the corpus.
The gains are one array with an entry for each bucket, whatever the size of the corpus, and score a document's array by one lookup.
Gumbel noise from a hash of the id turns "the k highest" into a draw without replacement in proportion to the weights.

The exact k-th key is found by distributed radix selection: (score descending, doc_id ascending) is a number of a few digits, each pass counts
the rows by one digit among those that share the digits found so far, and the driver gets no more than 2^11 counts. No rows are sorted for it.
The rows up to that key, and no others, are range-sorted; a row's rank is its place in its range plus the rows of earlier ranges.

Defined results: a null text has no words; documents without features have weight 0; a null id hashes like an empty one and
ranks after all ids; rows with equal keys, as repeated rows are, count as documents of their own: where only some of them are drawn, any do, as they are
alike in all that is returned; empty tables give an empty result; an empty target has no counts. Columns beyond doc_id and text aren't read.
Very long texts are read whole; a task holds one with its words.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise, read, text_parts

#: Buckets of hashed features.
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
#: Documents drawn of each hundred that have enough words.
PERCENT = 10
#: Bits of a digit of the radix selection.
BITS = 11
#: Word runs whose bucket a task remembers.
REMEMBERED = 500_000

_TABLE = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else 0x20 for b in range(256))


def features(docs: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words and hashed: the buckets of all runs of 1 to `longest` words, repeats included, as little-endian 32-bit numbers."""

    def rows(stream):
        import pyarrow as pa

        known: dict[bytes, int] = {}

        def bucket(run: bytes) -> int:
            at = known.get(run)
            if at is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                at = known[run] = zlib.crc32(run) % buckets
            return at

        for batch in stream:
            for part in text_parts(batch):
                counts, blobs = [], []
                for text in part.column("text"):
                    words = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
                    found = list(map(bucket, words))
                    for n in range(2, longest + 1):
                        found += [bucket(b" ".join(words[k : k + n])) for k in range(len(words) - n + 1)]
                    counts.append(len(words))
                    blobs.append(np.array(found, "<u4").tobytes())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())], names=["doc_id", "n_words", "hashed"])

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, hashed binary")


def bucket_counts(hashed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features stand in each bucket: each task sums an array, the tasks' arrays are summed by bucket."""

    def count(stream):
        import pyarrow as pa

        held = np.zeros(buckets, np.int64)
        for batch in stream:
            for blob in batch.column("hashed"):
                held += np.bincount(np.frombuffer(blob.as_buffer(), "<u4"), minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in hashed.select("hashed").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket, 1000 times the logarithm of its smoothed share in the target over that in the source, rounded down."""
    s, t, n = source.astype(np.float64), target.astype(np.float64), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def scored(hashed: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document. gain: an array of fixed length, sent with the tasks."""

    def rows(stream):
        import hashlib

        import pyarrow as pa

        for batch in stream:
            n, weight, h = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for k, (doc_id, blob) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("hashed"), strict=True)):
                own = np.frombuffer(blob.as_buffer(), "<u4")
                n[k] = len(own)
                weight[k] = int(gain[own].sum()) // len(own) if len(own) else 0
                h[k] = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
            noise = np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(n), pa.array(weight), pa.array(weight + noise)], names=["doc_id", "n_words", "n_features", "weight", "score"])

    kind = hashed.schema["doc_id"].dataType.simpleString()
    return hashed.mapInArrow(rows, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def kth(rows: DataFrame, keys: list[str], k: int) -> tuple[list[int], int]:
    """The k-th smallest key of rows (k from 1) and how many rows have a smaller one. keys: columns of longs, none of them null, first first.

    Digit by digit from the most significant on: counts by digit among the rows that share all digits before. Rows are read, not moved."""
    ends = rows.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in keys for f in (F.min, F.max))).first()
    found, here, below = [], rows, 0
    for c in keys:
        lo, width = ends[f"min_{c}"], int(ends[f"max_{c}"] - ends[f"min_{c}"]).bit_length()
        value = F.expr(f"CAST({c} AS DECIMAL(20, 0)) - {lo}") if width > 62 else F.col(c) - F.lit(lo).cast("long")
        shift, prefix = -(-width // BITS) * BITS, 0
        while shift:
            shift -= BITS
            digit = F.floor(value / F.lit(1 << shift).cast("decimal(20, 0)")) % (1 << BITS) if width > 62 else F.shiftright(value, shift).bitwiseAND((1 << BITS) - 1)
            counts = {int(r[0]): r[1] for r in here.groupBy(digit.cast("int").alias("digit")).count().collect()}  # 2^BITS rows at most
            for d in sorted(counts):
                if below + counts[d] >= k:
                    break
                below += counts[d]
            prefix = (prefix << BITS) | d
            low, high = lo + (prefix << shift), min(lo + ((prefix + 1) << shift) - 1, ends[f"max_{c}"])
            here = here.where(F.col(c).between(low, high))
        found.append(lo + prefix)
        here = here.where(F.col(c) == lo + prefix)
    return found, below


def ranked(rows: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """rows plus rank, 1 for the first: ranges are sorted each by itself and written, then get the number of rows before them."""
    place = F.monotonically_increasing_id()  # the range in the upper bits, the place in it below
    placed = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", place), "ranges")
    split = placed.withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = split.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return split.join(starts, "_range").withColumn(rank, number).drop("_range", "_start", "_at")


def draw(scores: DataFrame, enough: Column, percent: int = PERCENT) -> DataFrame:
    """scores plus rank: 1, 2, 3 and so on for the rows drawn of those with `enough`, null for all others. scores: a table, read more than once."""
    known = scores.withColumn("_fits", F.coalesce(enough, F.lit(False)))
    rows = known.where("_fits").select((-F.col("score")).alias("_score"), F.col("doc_id").isNull().cast("long").alias("_null"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id"))
    k = rows.count() * percent // 100
    if not k:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    keys = ["_score", "_null", "_id"]
    last, below = kth(rows, keys, k)
    all_keys = known.withColumns({"_score": -F.col("score"), "_null": F.col("doc_id").isNull().cast("long"), "_id": F.coalesce("doc_id", F.lit(0)).cast("long")})
    less = F.lit(False)
    for n, c in enumerate(keys):
        same = F.lit(True)
        for key, value in zip(keys[:n], last[:n], strict=True):
            same &= F.col(key) == value
        less |= same & (F.col(c) < last[n])
    equal = F.lit(True)
    for key, value in zip(keys, last, strict=True):
        equal &= F.col(key) == value
    up_to = all_keys.where(F.col("_fits") & (less | equal))
    order = [F.col(c).asc() for c in keys]
    drawn = ranked(up_to.select(*scores.columns, *keys), order, "rank")
    drawn = drawn.select(*scores.columns, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))  # rows like the last one beyond k stay undrawn
    rest = all_keys.where(~F.col("_fits") | ~(less | equal)).select(*scores.columns, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank. docs: doc_id, text; target: text."""
    hashed = materialise(features(docs, longest, buckets), "resample_features")
    wanted = features(target.select(F.lit(0).alias("doc_id"), "text"), longest, buckets)
    gain = gains(bucket_counts(hashed, buckets), bucket_counts(wanted, buckets))
    scores = materialise(scored(hashed, gain, seed), "resample_scores")
    discard(hashed)
    return draw(scores, F.col("n_words") >= least_words, percent)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "text"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")

