"""Best-fit packing by minimum bin slack.

A document is its token ids and one end id. Documents over the capacity are cut
into full pieces, the first one shorter; no other document is cut. Which
lengths share a sequence is decided on the histogram of lengths alone, at most
one row for each length up to the capacity, whatever the size of the corpus: a
bitset subset-sum over the lengths that are left finds the fullest sequence
that holds the longest of them, and that combination is removed as often as the
counts allow. Pieces then get ranks within their length, by buckets, so that a
length with a third of all pieces is spread over all tasks, and a rank is looked
up in the ranges of the plan.

Defined results: a null or empty text is one piece with the end id alone; equal
documents, also with equal or null ids, are separate pieces; an empty table
gives no rows; further columns are ignored; a text of any length is encoded in one go and
cut into pieces. Ids are those of the JSON file by `tokenizers`, so a special token's
string in a text is that token.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, partitions, read

CAPACITY, END_ID = 1024, 2
#: Pieces of one length that a single window group ranks, about.
BUCKET_ROWS = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"

_tokenizers: dict = {}


def tokenizer(path: str, ranks: str | None):
    """text -> ids by the tokenizer of a JSON file; one for each worker. ranks: the same vocabulary as a rank file,
    which gives the same ids several times faster where a text holds none of the special tokens."""
    if (path, ranks) not in _tokenizers:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        special = [x.content for x in whole.get_added_tokens_decoder().values()]
        plain = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

        def encode(text: str) -> list[int]:
            if plain is None or any(x in text for x in special):
                return whole.encode(text, add_special_tokens=False).ids
            return plain(text)

        _tokenizers[path, ranks] = encode
    return _tokenizers[path, ranks]


def vocabulary() -> tuple[str, str]:
    """The JSON file of the tokenizer and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece, with its ids if asked for; row is a number of its own. path: a tokenizer's JSON file."""
    path, ranks = (path, None) if path else vocabulary()

    def cut(batches):
        from pyspark import TaskContext

        encode, row = tokenizer(path, ranks), TaskContext.get().partitionId() << 40
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].array, pdf["text"].array, strict=True):
                ids = np.array(encode(text) + [end_id] if isinstance(text, str) else [end_id], dtype="<u4")
                first = len(ids) % capacity if len(ids) > capacity else len(ids)
                edges = [0, *range(first or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    own = ids[a:b]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(own.tobytes()), row) + ((own.astype("int32"),) if with_ids else ()))
                    row += 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "row"] + ["ids"] * with_ids)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select("doc_id", "text").mapInPandas(cut, PIECES + ", ids array<int>" * with_ids)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of lengths, longest first among equals, whose sum comes nearest to room from below."""
    bits, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, many = min(counts[length], room // length), 1
        while left > 0:
            many = min(many, left)
            steps.append((length, many, bits))
            bits |= (bits << (length * many)) & mask
            left -= many
            many *= 2
        if bits >> room:
            break
    at, found = bits.bit_length() - 1, {}
    for length, many, before in reversed(steps):
        if not before >> at & 1:
            found[length] = found.get(length, 0) + many
            at -= length * many
    return found


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): where the pieces of each length go."""
    left, used, ranges, sequence = dict(counts), dict.fromkeys(counts, 0), [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        found = fullest({k: v for k, v in left.items() if v}, capacity - longest) if longest < capacity else {}
        left[longest] += 1
        found[longest] = found.get(longest, 0) + 1
        times, offset = min(left[k] // n for k, n in found.items()), 0
        for length in sorted(found, reverse=True):
            for _ in range(found[length]):
                ranges.append((length, used[length], used[length] + times, sequence, offset))
                used[length] += times
                offset += length
            left[length] -= found[length] * times
            if not left[length]:
                del left[length]
        sequence += times
    return ranges


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset. Reads them more than once: give a table, whose row is the same each time."""
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # one row for each length up to capacity
    if any(not 0 < k <= capacity for k in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    ranges = spark.createDataFrame(plan(counts, capacity), "length long, lo long, hi long, first long, offset long")
    n = max(partitions(spark), sum(counts.values()) // BUCKET_ROWS + 1)
    dealt = pieces.withColumn("_b", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "_b").count().select("length", "_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_s"))
    own = F.row_number().over(Window.partitionBy("length", "_b").orderBy("row")) - 1
    ranked = dealt.withColumn("_r", own).join(starts, ["length", "_b"]).withColumn("_r", F.col("_r") + F.col("_s")).drop("_b", "_s")
    # The plan has at most a few ranges for each length and pattern, so its size doesn't follow the corpus.
    placed = ranked.join(F.broadcast(ranges), (ranked["length"] == ranges["length"]) & (F.col("_r") >= F.col("lo")) & (F.col("_r") < F.col("hi")))
    return placed.select(*(ranked[c] for c in pieces.columns), (F.col("first") + F.col("_r") - F.col("lo")).alias("sequence_id"), F.col("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of each sequence; packed must carry ids. A group holds no more ids than the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    cut = materialise(pieces(docs, path), "pieces")
    out = materialise(pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"), "packed")
    discard(cut)
    return out


def op1_packing(spark, sf_dir) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents", "doc_id", "text"))
