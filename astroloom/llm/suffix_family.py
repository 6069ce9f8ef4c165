"""A logarithmic family of suffix arrays that is kept in the shared folder and takes batch after batch.

family = SuffixFamily(spark, path)
cleaned = family.add(docs, "2024-05")

A batch loses each byte under a 50-byte string that also starts in an earlier batch,
or in a document of the same batch with a smaller id.

1. The batch becomes its suffix array: a row for each place, by the 50 bytes that start there,
   dealt into buckets by string and in order within them. This is the one shuffle of texts; repetitions
   at neighbouring places (blanks, rulers) are one row with a length.
2. The array is merge-scanned against itself and each level: bucket by bucket, both sides in order, no shuffle,
   since all levels have the same buckets. Each place gets a verdict; those of a document come together and are cut out.
3. The array's distinct strings are the new level. While the last two levels are of like size they
   merge, bucket by bucket, so sizes at least double from one to the next: a string is written
   again log2(batches) times, and a scan reads log2(batches) levels.
4. A new version of the manifest names batches and levels. Readers take the latest version whose write was finished, so a driver that
   dies before leaves the family as it was; only then are replaced levels deleted.

Strings are compared whole; nothing is sampled or capped. One driver at a time adds to a family. The number of buckets
is fixed when the family is made: size it so that the largest level's share of a bucket suits a task's disk; tasks stream and spill.

Defined results: a null text is empty; a text under 50 bytes keeps all; documents with equal ids in a
batch don't remove from each other; a null id counts as greater than any; an empty batch adds an empty level; further columns are ignored;
a batch's name is taken once, a second add under it raises ValueError.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blobs, discard, materialise, shared_dir, text_parts, utf8
from .suffix_dedup import LAST, MATCH

#: Places that are worked through at once.
PLACES = 200_000
MANIFEST = "version long, buckets int, batches array<string>, levels array<struct<name:string,rows:long>>"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _places(batches):
    """(uid, key, at, n, s) of each place where a 50-byte string starts; n neighbouring places with one string are one row."""
    import pyarrow as pa

    for batch in batches:
        for part in text_parts(batch):
            buf, lengths = utf8(part.column("text"))
            ends = np.cumsum(lengths)
            uid, key = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("uid", "key"))
            for a in range(0, len(buf) - MATCH + 1, PLACES):
                start = np.arange(a, min(a + PLACES, len(buf) - MATCH + 1))
                doc = np.searchsorted(ends, start, "right")
                ok = start + MATCH <= ends[doc]
                start, doc = start[ok], doc[ok]
                if not len(start):
                    continue
                view = np.lib.stride_tricks.sliding_window_view(buf, MATCH)
                same = (doc[1:] == doc[:-1]) & (buf[start[1:] - 1] == buf[start[1:] + MATCH - 1])
                rows = view[start]
                same[same] = (rows[1:][same] == rows[:-1][same]).all(axis=1)
                new = np.flatnonzero(np.concatenate(([True], ~same)))
                n = np.diff(np.append(new, len(start)))
                start, doc, rows = start[new], doc[new], rows[new]
                s = blobs(np.arange(len(rows) + 1) * MATCH, rows.ravel())
                yield pa.record_batch({"uid": uid[doc], "key": key[doc], "at": (start - ends[doc] + lengths[doc]).astype(np.int64), "n": n.astype(np.int32), "s": s})


def _cut(batches):
    """What is kept of each text, given the places of its strings that go."""
    import pyarrow as pa

    for batch in batches:
        for part in text_parts(batch):
            out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept")}
            for text, places in zip(part.column("text"), part.column("places"), strict=True):
                raw = np.frombuffer((text.as_py() or "").encode("utf-8"), np.uint8)
                edge = np.zeros(len(raw) + 1, np.int32)
                if places.is_valid:
                    at, n = (places.values.field(c).to_numpy().astype(np.int64) for c in ("at", "n"))
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + n + MATCH - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((gone & ~np.concatenate(([False], gone[:-1]))[: len(gone)]).sum()))
                out["kept"].append(raw[~gone].tobytes())
            yield pa.record_batch([part.column("doc_id"), *(pa.array(v, pa.binary() if c == "kept" else pa.int64()) for c, v in out.items())], ["doc_id", *out])


class SuffixFamily:
    """The levels under path, made with `buckets` buckets if there are none yet."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark = spark
        self.path = path or f"{shared_dir(spark)}/suffix-family-{uuid.uuid4().hex}"
        self.state = self._latest() or {"version": 0, "buckets": buckets, "batches": [], "levels": []}
        for name, _ in self.levels:
            if not spark.catalog.tableExists(name):
                spark.sql(f"CREATE TABLE `{name}` (s BINARY) USING parquet CLUSTERED BY (s) SORTED BY (s) INTO {self.state['buckets']} BUCKETS LOCATION '{self.path}/{name}'")

    @property
    def levels(self) -> list[tuple[str, int]]:
        """Name and number of strings of each level, the largest first."""
        return [(level["name"], level["rows"]) for level in self.state["levels"]]

    def _latest(self) -> dict | None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return None
        last = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest").orderBy(F.desc("version")).first()
        return last.asDict(recursive=True) if last else None

    def _save(self, batches: list[str], levels: list[tuple[str, int]]) -> None:
        state = {"version": self.state["version"] + 1, "buckets": self.state["buckets"], "batches": batches, "levels": [{"name": n, "rows": r} for n, r in levels]}
        self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/manifest")
        self.state = state

    def _write(self, df: DataFrame, kind: str) -> DataFrame:
        """df, in buckets of s already, as a table in order of s."""
        name = f"{kind}_{uuid.uuid4().hex}"
        df.write.format("parquet").option("compression", "zstd").option("path", f"{self.path}/{name}").bucketBy(self.state["buckets"], "s").sortBy("s").saveAsTable(name)
        out = self.spark.table(name)
        out._loom_path, out._loom_table = f"{self.path}/{name}", name
        return out

    def add(self, docs: DataFrame, name: str) -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans, kept (binary) of each row of docs, whose strings are indexed then. docs: doc_id, text."""
        if name in self.state["batches"]:
            raise ValueError(f"batch {name!r} stands in the family already")
        key = F.col("doc_id").cast("long")
        texts = materialise(docs.select(key.alias("doc_id"), F.coalesce(key, F.lit(int(LAST))).alias("key"), "text", F.monotonically_increasing_id().alias("uid")), "texts")
        places = texts.select("uid", "key", "text").mapInArrow(_places, "uid long, key long, at long, n int, s binary")
        array = self._write(places.repartition(self.state["buckets"], "s"), "array")
        own = array.groupBy("s").agg(F.min("key").alias("least"))
        # Whole merges of two sides in order: no hint, as neither side's size is bounded; buckets spare the shuffle.
        known, earlier = own, F.lit(False)
        for k, (level, _) in enumerate(self.levels):
            known = known.join(self.spark.table(level).withColumn(f"in{k}", F.lit(True)), "s", "left")
            earlier = earlier | F.col(f"in{k}").isNotNull()
        known = known.select("s", F.when(earlier, F.lit(int(np.iinfo(np.int64).min))).otherwise(F.col("least")).alias("least"))
        gone = array.join(known, "s").where(F.col("key") > F.col("least")).groupBy("uid").agg(F.collect_list(F.struct("at", "n")).alias("places"))
        out = texts.join(gone, "uid", "left").select("doc_id", "text", "places").mapInArrow(_cut, RESULT)
        out = materialise(out, "cleaned")
        fresh = self._write(own.select("s"), "level")
        levels, old = [*self.levels, (fresh._loom_table, fresh.count())], []
        while len(levels) > 1 and levels[-2][1] < 2 * levels[-1][1]:
            a, b = levels[-2:]
            merged = self._write(self.spark.table(a[0]).join(self.spark.table(b[0]), "s", "full_outer").select("s"), "level")
            levels[-2:], old = [(merged._loom_table, merged.count())], [*old, a[0], b[0]]
        self._save([*self.state["batches"], name], levels)
        for table in old:
            gone_table = self.spark.table(table)
            gone_table._loom_path, gone_table._loom_table = f"{self.path}/{table}", table
            discard(gone_table)
        discard(array)
        discard(texts)
        return out
