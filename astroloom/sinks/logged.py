"""A combined table that batches are appended to, with a log that readers follow.

A batch is written into a folder of its own and then named in the log, one small file for each commit, numbered in order, created only
if it isn't there: of two writers that try for one number, one gets it and the other takes the next. A batch whose name is in the log already is
dropped, so a repeated append adds nothing. The log holds the range of each batch's key; where ranges overlap, readers take a key from
the earliest batch that has it, other batches are read as they are. No append reads what the table holds.

Defined results: rows with one key within a batch count once, any of them; a null key is a key; an append without rows is logged and
adds nothing; a writer that dies before its commit leaves a folder that no reader sees; reading before start() raises.
A commit is a rename to a name that must be free, which is atomic in HDFS, or a link where the store is a local folder; a store whose rename replaces files needs another one."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _created(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file was made, whole at once; False where there is one already. It is written under another name and then given its own."""
    fs, where = _fs(spark, path)
    fs.mkdirs(where.getParent())
    if fs.exists(where):
        return False
    if fs.getScheme() == "file":  # a local rename would replace the file, a link doesn't
        inner = where.toUri().getPath()
        with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(inner), prefix=".", suffix=".tmp") as f:
            f.write(text)
            f.flush()
            try:
                os.link(f.name, inner)
            except FileExistsError:
                return False
        return True
    other = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(other, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.rename(other, where):
        return True
    fs.delete(other, False)
    return False


def _text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def start(spark: SparkSession, path: str, schema: str | T.StructType, key: str, row_group_bytes: int = 134_217_728) -> None:
    """An empty table. key: a column that orders; row_group_bytes: of the files that appends write."""
    typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not _created(spark, f"{path}/_log/table.json", json.dumps({"schema": typed.jsonValue(), "key": key, "row_group_bytes": row_group_bytes})):
        raise ValueError(f"{path} has a table")


def log(spark: SparkSession, path: str) -> list[dict]:
    """What was committed, in order: number, batch, folder, low, high (of the key, as text of its JSON; null without rows), nulls."""
    fs, where = _fs(spark, f"{path}/_log")
    names = sorted(s.getPath().getName() for s in fs.listStatus(where))
    return [json.loads(_text(spark, f"{path}/_log/{n}")) | {"number": int(n[:20])} for n in names if n[:20].isdigit()]


def append(df: DataFrame, path: str, batch: str) -> bool:
    """Add the rows of df under the batch's name; whether they were added."""
    spark = df.sparkSession
    table = json.loads(_text(spark, f"{path}/_log/table.json"))
    key, columns = table["key"], [f["name"] for f in table["schema"]["fields"]]
    if any(x["batch"] == batch for x in log(spark, path)):
        return False
    folder = f"data/{uuid.uuid4().hex}"
    df.select(*columns).dropDuplicates([key]).write.option("parquet.block.size", table["row_group_bytes"]).parquet(f"{path}/{folder}")
    own = spark.read.schema(T.StructType.fromJson(table["schema"])).parquet(f"{path}/{folder}")
    ends = own.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.bool_or(F.col(key).isNull()).alias("nulls")).first()  # from the files' own statistics
    plain = lambda v: v if v is None or isinstance(v, int | float | str) else str(v)
    entry = json.dumps({"batch": batch, "folder": folder, "low": plain(ends["low"]), "high": plain(ends["high"]), "nulls": bool(ends["nulls"])})
    while True:
        done = log(spark, path)
        if any(x["batch"] == batch for x in done):
            fs, where = _fs(spark, f"{path}/{folder}")
            fs.delete(where, True)
            return False
        if _created(spark, f"{path}/_log/{len(done):020d}.json", entry):
            return True


def _groups(entries: list[dict]) -> list[list[dict]]:
    """Batches whose ranges of keys meet, directly or through others; batches with null keys meet each other."""
    out: list[list[dict]] = []
    for x in sorted((x for x in entries if x["low"] is not None), key=lambda x: x["low"]):
        if out and x["low"] <= max(y["high"] for y in out[-1]):
            out[-1].append(x)
        else:
            out.append([x])
    null = [x for x in entries if x["nulls"]]
    together = [g for g in out if any(x in null for x in g)]
    alone = [x for x in null if x["low"] is None]
    if len(null) > 1:
        return [g for g in out if g not in together] + [sum(together, []) + alone]
    return out + [[x] for x in alone]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows, each key once."""
    table = json.loads(_text(spark, f"{path}/_log/table.json"))
    schema, key = T.StructType.fromJson(table["schema"]), table["key"]
    groups = _groups(log(spark, path))
    load = lambda xs: spark.read.schema(schema).parquet(*(f"{path}/{x['folder']}" for x in xs))
    single = [g[0] for g in groups if len(g) == 1]
    parts = [load(single)] if single else []
    for g in groups:
        if len(g) > 1:
            numbers = F.create_map(*(F.lit(v) for x in g for v in (x["folder"].split("/")[-1], x["number"])))
            which = F.try_element_at(numbers, F.element_at(F.split(F.input_file_name(), "/"), -2))
            first = Window.partitionBy(key).orderBy("_number")
            parts.append(load(g).withColumn("_number", which).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_number", "_n"))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
