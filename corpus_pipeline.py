"""From raw documents to packed training sequences, stage by stage.

Each stage gets what its predecessor kept, as a table with the columns of
documents, and decides anew on all of it. The last one returns pieces with
their places in sequences.

Defined results: texts that are null or empty have no line of good quality and
are judged like any other; documents with a null doc_id are no one's copies, but are
cut and checked for leaks as all are; of documents with one id each is judged by
itself, but leaves with its like where one is a near duplicate; empty tables pass through as empty tables; columns beyond those of
documents are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from astroloom.llm import decontamination, jaccard_join, packing, quality_crf, suffix_dedup
from astroloom.llm.common import discard, materialise, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents under this quality go; well under the bound of the classifier's own prediction, so that doubtful ones stay.
LEAST_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of low quality."""
    labels = read(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality_crf.model_for(docs.select("doc_id", "text"), labels)
    return quality_crf.keep(docs.select(*COLUMNS), model, LEAST_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of near duplicates."""
    found = jaccard_join.near_duplicates(docs.select("doc_id", "text"))
    gone = found.where("doc_id <> class_id").select("doc_id")
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages out that a document with a smaller id holds; characters that a cut splits go too. Documents left without text stay, as empty ones."""
    out = suffix_dedup.cut(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.clean(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, and where they stand."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", pack),
]

#: The classifier, the groups of near duplicates and the packing can't be said in SQL; tests/llm compares them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written as a table before the next reads it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage{k}")
        if before is not None:
            discard(before)
        before = docs
    return docs
