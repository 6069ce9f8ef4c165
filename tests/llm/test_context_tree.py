"""The score of texts under context trees against a plain tree of dictionaries."""

from __future__ import annotations

import zlib

import brute
import pytest
from pyspark.sql import functions as F

TEXTS = ["abracadabra, abracadabra", "The cat sat on the mat. The cat sat.", "ABRA cat", "", None, "völlig anders: ß, ñ, 漢字", "mat " * 30, "the cat", "zzz"]


def test_scores_equal_a_plain_tree(spark):
    from astroloom.llm import ctw

    docs = list(enumerate(TEXTS))
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2 or i == 7
    df = spark.createDataFrame([(i, t, held(i)) for i, t in docs], "doc_id long, text string, held_out boolean").repartition(3)
    assert any(held(i) for i, _ in docs) and not all(held(i) for i, _ in docs)
    for depth in (ctw.DEPTH, 2):
        want = brute.ctw(docs, held, depth)
        got = {r["doc_id"]: r["score"] for r in ctw.score(df, depth).collect()}
        assert got == pytest.approx(want, rel=1e-6)
    assert ctw.score(df.where(F.col("held_out"))).count() == sum(held(i) for i, _ in docs)
