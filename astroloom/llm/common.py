"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import pickle
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of the word rule: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: Spark's setting that removes a query's shuffle files when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    """The named columns of a table, so that the scan reads nothing else."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*cols) if cols else df


def partitions(spark: SparkSession) -> int:
    """How many shuffle partitions the session was given; sized to the data by whoever runs it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or for local tests one of our own."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not getattr(spark, "_loom_dir", None):
        spark._loom_dir = tempfile.mkdtemp(prefix="loom-")
    return spark._loom_dir


def materialise(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write df as Parquet into the shared folder, in folders by `by`, and read it back; later plans start from the files.

    The shuffle files behind the table go with the end of the write; nothing reads them any more."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, was)
    out = spark.read.schema(df.schema).parquet(path)
    out._loom_path = path
    return out


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Write df as a table bucketed by key, in the shared folder: grouping it by key needs no shuffle from then on."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{table}"
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(partitions(spark), key).saveAsTable(table)
    out = spark.table(table)
    out._loom_path, out._loom_table = path, table
    return out


def discard(table: DataFrame, part: str = "") -> None:
    """Delete what materialise or bucketed wrote, or one of its folders, once nothing reads it any more.

    Both collectors run, so that Spark's cleaner finds the plans that made it unreachable and drops their shuffle files and broadcasts."""
    spark = table.sparkSession
    if getattr(table, "_loom_table", None):
        spark.sql(f"DROP TABLE IF EXISTS `{table._loom_table}`")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table._loom_path}/{part}".rstrip("/"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def to_batches(docs: DataFrame, batch_bytes: int) -> DataFrame:
    """docs plus batch, a number, and size, the bytes of the text; a longer text than batch_bytes ends its batch. docs has a column text."""
    names = [*docs.columns, "batch", "size"]
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), T.StructField("batch", T.LongType()), T.StructField("size", T.LongType())])

    def numbered(stream):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        first, held = TaskContext.get().partitionId() << 32, 0
        for rows in stream:
            size = pc.fill_null(pc.binary_length(rows.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            end = held + np.cumsum(size)
            held = int(end[-1]) if len(end) else held
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(first + (end - size) // batch_bytes), pa.array(size)], names=names)

    return docs.mapInArrow(numbered, schema)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column of an Arrow table one after the other, and the length of each; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, np.diff(offsets)


def blobs(edges: np.ndarray, data: np.ndarray):
    """An Arrow array of binary values: data[edges[0]:edges[1]], data[edges[1]:edges[2]], and so on."""
    import pyarrow as pa

    raw, step = np.ascontiguousarray(data), data.dtype.itemsize
    offsets = np.ascontiguousarray((edges * step).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def unblob(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column of an Arrow table as one array, and how many entries each value has."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype), np.array([len(v) // np.dtype(dtype).itemsize for v in values], np.int64)


def let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda variable isn't expanded for each use."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words between white space, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; the split into training and held-out rows."""
    return F.crc32(doc_id.cast("string").cast("binary")) % m


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, training: Column, rows: int) -> DataFrame:
    """doc_id, text and y of at most `rows` labelled training documents, chosen by hash of the id, so alike on each run."""
    y = labels.select("doc_id", F.col(target).cast("int").alias("y")).where(F.col("y").isin(0, 1) & training)
    chosen = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `rows` pairs of numbers


def text_parts(batch, limit: int = 1_000_000):
    """Slices of an Arrow batch with about `limit` bytes of text each, or one longer text, so that temporary arrays stay small."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def chunks(pdf, limit: int = 1_000_000):
    """Parts of a pandas batch with about `limit` characters of text each, so that temporary arrays stay small."""
    size = pdf["text"].str.len().fillna(0).to_numpy().cumsum()
    part = (size // limit).astype(int)
    for _, own in pdf.groupby(part, sort=True):
        yield own


# ---- arrays in tasks -----------------------------------------------------------------------

_P = 0x9E3779B97F4A7C15
_powers: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of an odd number and of its inverse modulo 2^64; kept by each worker."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            x = np.full(max(n, 1 << 20), base, dtype=np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """h such that span_hash(h, start, end) is a 64-bit hash of buf[start:end] wherever it stands."""
    x = buf.astype(np.uint64)
    x += np.uint64(1)
    x *= powers(len(buf) + 1)[0][: len(buf)]
    h = np.empty(len(buf) + 1, np.uint64)
    h[0] = 0
    np.cumsum(x, out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    x = h[end] - h[start]
    x *= powers(len(h))[1][start]
    return x


def mixed(x: np.ndarray) -> np.ndarray:
    """All bits of x spread over all bits."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def dump(*arrays, level: int = 1) -> bytes:
    """Arrays as a compressed blob: few rows with much in each cost a shuffle far less than many small rows."""
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(arrays, 5))


def load(blob: bytes) -> tuple:
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (counts[0] of them), then the same for the next."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))
