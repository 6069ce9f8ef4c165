"""Text files as relations: fixed width, white space, lists of names, ledgers; and the matching sinks.

All read through spark.read.text, so a path can be a folder, a glob or a list in
any store, and Spark splits large files among tasks.

Defined results: blank lines are dropped; a field that is blank or outside its
line is null; a line with fewer fields than names has null in the last ones; an
empty file gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "")


def _typed(value: Column, kind: str) -> Column:
    return F.nullif(F.trim(value), F.lit("")).try_cast(kind)


def fixed_width(spark: SparkSession, path: str | list[str], fields: dict[str, tuple[int, int, str]]) -> DataFrame:
    """fields: name -> (first place from 0, width, type). A value that isn't of its type is null."""
    return _lines(spark, path).select(*(_typed(F.substring("value", start + 1, width), kind).alias(name) for name, (start, width, kind) in fields.items()))


def white_space(spark: SparkSession, path: str | list[str], schema: str | StructType, header: bool = False) -> DataFrame:
    """Fields between blanks and tabs, named and typed by schema. With header, lines that begin with the first name are dropped."""
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    parts = _lines(spark, path).select(F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ").alias("p"))
    if header:
        parts = parts.where(F.get("p", F.lit(0)) != fields[0].name)
    return parts.select(*(F.get("p", F.lit(k)).try_cast(f.dataType).alias(f.name) for k, f in enumerate(fields)))


def name_lists(spark: SparkSession, folder: str, suffix: str = "_tiles.txt") -> DataFrame:
    """band and name: a line of `<band>_tiles.txt` is the name of a file."""
    lines = spark.read.option("pathGlobFilter", f"*{suffix}").text(folder).select("value", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"))
    name = F.trim("value")
    return lines.where(name != "").select(F.expr(f"left(file, length(file) - {len(suffix)})").alias("band"), name.alias("name"))


def listed_files(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """path, name, size of files under a folder; their content isn't read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))


def tile_folders(files: DataFrame, detections: str = r"_ugri_photoz_ext\.cat$", left_out: list[tuple[int, int]] | None = None) -> DataFrame:
    """Distinct (xxx, yyy) of folders NAME.xxx.yyy that hold a file whose name matches; other folders are skipped. files: path, as listed_files gives it."""
    folder = F.element_at(F.split("path", "/"), -2)
    number = lambda k: F.regexp_extract(folder, r"^[^.]+\.(\d+)\.(\d+)$", k).try_cast("int")
    tiles = files.where(F.col("path").rlike(detections)).select(number(1).alias("xxx"), number(2).alias("yyy")).where("xxx is not null and yyy is not null").distinct()
    for x, y in left_out or []:
        tiles = tiles.where((F.col("xxx") != x) | (F.col("yyy") != y))
    return tiles


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Distinct entries of a ledger; none where nothing was written yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "entry string")
    return _lines(spark, path).select(F.trim("value").alias("entry")).distinct()


def to_ledger(entries: Column, df: DataFrame, path: str) -> None:
    """Append entries; Spark's commit takes the place of a lock."""
    df.select(entries.cast("string").alias("value")).write.mode("append").text(path)


def coordinates(spark: SparkSession, flat: list[float]) -> DataFrame:
    """ID, ra, dec from ra, dec, ra, dec ... as a user types them."""
    if not flat or len(flat) % 2:
        raise ValueError("coordinates are pairs of ra and dec")
    return spark.createDataFrame([(k + 1, float(a), float(d)) for k, (a, d) in enumerate(zip(flat[::2], flat[1::2], strict=True))], "ID long, ra double, dec double")
