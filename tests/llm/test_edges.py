"""Nulls, empty and very long texts, repeated rows and ids, empty tables and columns with clashing names, for each operator and stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

LONG = "the quick brown fox jumps over the lazy dog again and again\n" * 4000
ROWS = [(1, None), (1, ""), (2, "same words in both rows here, seen twice over"), (2, "same words in both rows here, seen twice over"), (3, LONG), (4, LONG + "x"), (None, "no id at all but words enough for a text"), (None, None), (5, "\n\n \t"), (6, "ß" * 400), (7, "word " * 600)]
CLASHING = ["batch", "size", "part", "key", "n", "h", "w", "t", "y", "_s", "_j", "_leak", "_key", "score", "kept", "licenses", "sentence_ids", "template", "host", "x0", "bits", "state"]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    return docs.withColumns({c: F.lit(f"mine {c}") for c in CLASHING}).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2, "z") for i in range(1, 8)] + [(None, 1, 1, "z"), (2, None, None, "z")], "doc_id long, quality int, toxic int, score string")


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda x: (x is None, x or 0))


WANT = sorted((i for i, _ in ROWS), key=lambda x: (x is None, x or 0))


def test_packing(odd):
    from astroloom.llm import packing

    assert set(ids(packing.pack_documents(odd))) == set(WANT)
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_context_trees(odd):
    from astroloom.llm import ctw

    held = odd.withColumn("held_out", F.coalesce(F.col("doc_id") == 2, F.lit(False)))
    out = ctw.score(held)
    assert ids(out) == WANT and out.where("score is null or score > 0").count() == 0
    assert ctw.score(held.limit(0)).count() == 0
    assert ctw.score(held.withColumn("held_out", F.lit(True))).where("n_known > 0").count() == 0


def test_rules(odd):
    from astroloom.llm import quality_rules as Q

    out = Q.cascade(Q.text_stats(odd), Q.text_stats(Q.sampled(odd)))
    assert ids(out) == WANT and out.where("kept is null").count() == 0


def test_repeats(odd):
    from astroloom.llm import suffix_dedup

    got = {}
    for r in suffix_dedup.cut(odd).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sorted(got, key=lambda x: (x is None, x or 0)) == sorted(set(WANT), key=lambda x: (x is None, x or 0))
    assert {len(v) for k, v in got.items() if k in (1, 2)} == {2}
    assert got[3][0].text == LONG and got[4][0].text in ("", "x") and got[4][0].batch == "mine batch"
    assert all(r[c] == f"mine {c}" for v in got.values() for r in v for c in CLASHING)
    assert {r.text for r in got[2]} == {ROWS[2][1]}  # equal ids don't remove from each other


def test_leaks(odd, spark):
    from astroloom.llm import decontamination as D

    items = spark.createDataFrame([(1, "no id at all but words enough for a text"), (2, None), (3, ""), (4, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    kept = D.clean(odd, items)
    assert kept.columns == odd.columns
    assert ids(kept) == sorted((i for i, t in ROWS if not (t and ("lazy dog" in t or t.startswith("no id")))), key=lambda x: (x is None, x or 0))
    out = D.by_document(odd, items)
    assert ids(out) == WANT and out.where("contaminated").count() == 3
    assert D.clean(odd, items.limit(0)).count() == len(ROWS) and D.clean(odd.limit(0), items).count() == 0


def test_near(odd):
    from astroloom.llm import jaccard_join

    rows = jaccard_join.near_duplicates(odd).collect()
    assert sorted((r.doc_id for r in rows), key=lambda x: (x is None, x or 0)) == WANT
    assert {(r.class_id, r.n_links) for r in rows if r.doc_id is None} == {(None, 0)}
    assert {r.class_id for r in rows if r.doc_id in (3, 4)} == {3}


def test_urls(spark):
    from astroloom.llm import url_filter as U

    pages = spark.createDataFrame([(1, None, "m"), (1, None, "m"), (None, "http://a.net/" + "x/" * 30, "m"), (2, "http://a.net/" + "y" * 100_000, "m"), (3, "", "m")], "page_id long, url string, template string")
    out = U.judge(pages.withColumns({c: F.lit(1) for c in ("n", "n_block", "node", "own", "purity", "rule")}))
    assert out.count() == 5 and out.where("verdict is null").count() == 0
    assert U.judge(pages.limit(0)).count() == 0


def test_toxicity(odd, labels):
    from astroloom.llm import toxicity as T

    model = T.model_for(odd, labels)
    out = T.score(odd, model)
    assert ids(out) == WANT and out.where("score is null or score < 0 or score > 1").count() == 0
    assert T.score(odd.limit(0), T.model_for(odd.limit(0), labels.limit(0))).count() == 0


def test_quality(odd, labels):
    from astroloom.llm import quality_crf as Q

    model = Q.model_for(odd, labels)
    assert ids(Q.score(odd, model)) == WANT
    kept = Q.keep(odd, model, 0.0)
    assert kept.columns == odd.columns and kept.count() == len(ROWS)
    assert Q.score(odd.limit(0), Q.model_for(odd.limit(0), labels.limit(0))).count() == 0


def test_licences(odd):
    from astroloom.llm import license_scan as L

    out = L.scan(odd)
    assert ids(out) == WANT and out.where("_s <> 'mine _s' or _j <> 'mine _j'").count() == 0


def test_stages(odd, spark, tmp_path):
    import corpus_pipeline as P

    docs = odd.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), "batch", "_leak")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(1, 8)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no id at all but words enough for a text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == P.COLUMNS, name
        out.count()
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert set(ids(P.run(spark, str(tmp_path)))) <= set(WANT)
