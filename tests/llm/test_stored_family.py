"""The stored family of suffix arrays, batch after batch, against every 50-byte string in a dictionary."""

from __future__ import annotations

import hashlib
import random

import brute
import pytest
from pyspark.sql import functions as F

from astroloom.llm import suffix_family
from astroloom.llm.suffix_family import SuffixFamily

SCHEMA = "doc_id long, text string, lang string"


def made(seed: int, n: int) -> list:
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé \n") for _ in range(r.randint(1, 9)))
    passages = ["".join(word() for _ in range(r.randint(8, 40))) for _ in range(4)] + ["ab" * 60, " " * 300]
    docs = []
    for i in range(n):
        text = "".join(r.choice(passages)[r.randint(0, 30) :] if r.random() < 0.4 else word() for _ in range(r.randint(0, 12)))
        docs.append((i, r.choice([text, text, text, None, docs[-1][1] if docs else text])))
    return docs


def rows(out) -> dict:
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out.collect()}


@pytest.mark.parametrize("places", [71, 200_000])
def test_batches_equal_one_dictionary(spark, tmp_path, monkeypatch, places):
    monkeypatch.setattr(suffix_family, "PLACES", places)
    docs = made(places, 60)
    want = brute.repeated(docs)
    family = SuffixFamily(spark, str(tmp_path / "family"), buckets=4)
    cuts, got = [0, 25, 30, 45, 60], {}
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if k == 2:  # another driver goes on: tables are registered anew from the manifest
            for name, _ in family.levels:
                spark.sql(f"DROP TABLE `{name}`")
            family = SuffixFamily(spark, family.path)
        got |= rows(family.add(spark.createDataFrame([(i, t, "x") for i, t in docs[a:b]], SCHEMA), f"batch {k}"))
        sizes = [n for _, n in family.levels]
        assert all(x >= 2 * y for x, y in zip(sizes[:-1], sizes[1:], strict=True))
    assert got == want
    assert sum(v[1] for v in got.values()) > 0
    strings = {t.encode()[k : k + 50] for _, t in docs if t for k in range(len(t.encode()) - 49)}
    assert sum(sizes) >= len(strings) and family.state["batches"] == [f"batch {k}" for k in range(4)]


def test_odd_batches(spark, tmp_path):
    family = SuffixFamily(spark, str(tmp_path / "family"), buckets=2)
    assert family.add(spark.createDataFrame([], SCHEMA), "none").count() == 0
    long = "".join(chr(97 + (k * k) % 26) + str(k) for k in range(40_000))
    first = rows(family.add(spark.createDataFrame([(5, long, "a"), (5, long, "b"), (None, long[:500], "c"), (7, "short", "d"), (8, "", "e"), (9, None, "f")], SCHEMA).where("doc_id is null or doc_id <> 5 or lang = 'a'"), "one"))
    assert first[5][1] == 0 and first[None][1] == 500 and first[7][:2] == (5, 0) and first[8][0] == first[9][0] == 0
    again = rows(family.add(spark.createDataFrame([(1, long, "a")], SCHEMA), "two"))  # a smaller id that comes later goes
    assert again[1][:3] == (len(long), len(long), 1)
    with pytest.raises(ValueError, match="already"):
        family.add(spark.createDataFrame([(2, "x", "a")], SCHEMA), "two")


def test_scan_shuffles_no_level(spark, tmp_path):
    """Levels and the new array meet in their buckets."""
    family = SuffixFamily(spark, str(tmp_path / "family"), buckets=4)
    for k in range(2):
        family.add(spark.createDataFrame([(i, t, "x") for i, t in made(k, 12)], SCHEMA), str(k))
    a = spark.table(family.levels[0][0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = a.join(a.select(F.col("s").alias("t")), F.col("s") == F.col("t"), "full_outer")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
