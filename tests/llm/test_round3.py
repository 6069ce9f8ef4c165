"""Source divergence audit, mixing by curriculum and importance resampling against plain versions and SQL, odd rows included."""

from __future__ import annotations

import math

import brute3
import pytest
import twins
from pyspark.sql import functions as F

from astroloom.llm import curriculum, divergence, resampling

SF = "/root/testdata/sf0.001"
LONG = "Zebra zebra ÄPFEL äpfel lamp 12 x\n" * 4000
ODD = [
    (1, "en", "a", "One two; two THREE"), (1, "en", "a", "One two; two THREE"), (2, "en", "b", "two three-one"), (3, "en", None, "One, three"), (4, "en", "", None), (5, None, "a", "One two"),
    (None, "en", "c", LONG), (None, None, None, None), (6, "en", "b", ""), (7, "en", "b", "äpfel ÄPFEL lamp\tzebra two"), (8, "en", "a", "lamp lamp lamp äpfel zebra Two"), (9, "de", "a", "nur hier"), (9, "de", "d", "\n \t"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, lang string, source string, text string").withColumns({c: F.lit("mine") for c in ("batch", "size", "n", "term", "order", "taken", "target", "rank", "score", "hashed", "_b")}).cache()


@pytest.mark.parametrize("name", ["op11_divergence", "op12_mixing"])
def test_twin(spark, name):
    from astroloom.llm import registry

    assert twins.differ(registry.queries()[name](spark, SF), twins.connect(SF), registry.oracle_sql()[name]) == ""


def test_audit_of_odd_rows(odd):
    got = [tuple(r)[:6] for r in divergence.audit(odd, batch_bytes=60).collect()]
    assert len(got) == len(set(got)) and set(got) == brute3.audit([r[1:] for r in ODD])
    assert divergence.audit(odd.limit(0)).count() == 0


def test_audit_sums_terms_of_blocks(odd, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 3)
    assert {tuple(r)[:6] for r in divergence.audit(odd, least_docs=2).collect()} == brute3.audit([r[1:] for r in ODD], 2)


def test_shares_of_counts_beyond_nine_digits(spark):
    rows = [(0, 1), (10**13, 10**13 + 5), (7 * 10**12, 9 * 10**14), (3, 7)]
    got = spark.createDataFrame(rows, "n long, total long").select(divergence.share("n", "total")).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (n + 1) // total for n, total in rows]


def test_targets_fill_up_and_share_anew(spark):
    sizes = {"a": 10, "b": 1000, "c": 300, "d": 0, "e": 40, None: 700}
    weights = {"a": 5.0, "b": 2.0, "c": 1.0, "d": 5.0, "e": 2.0, None: 1.0}
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in curriculum.targets(curriculum.cycling([5.0, 2.0, 1.0], [1.5, 1.0, 0.5])(table), 1.5, 2).collect()}
    want = brute3.level(sizes, weights, 1.5 * sum(sizes.values()), 2)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-12) for s in want)


def test_mix_of_odd_rows(odd):
    schedule = curriculum.cycling([5.0, 2.0, 1.0], [1.5, 1.0, 0.5])
    mixed = curriculum.mix(odd, schedule).cache()
    rows = mixed.collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in rows) == sorted((i or 0, len((t or "").split())) for i, _, _, t in ODD)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == math.floor(own[0]["target"] + 0.5)
    assert curriculum.mix(odd.limit(0), schedule).count() == 0
    again = curriculum.mix(odd.repartition(3), schedule)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows))


def test_order_follows_the_schedule(spark):
    """At any time the words of each source so far are the integral of its schedule, and copies of a document lie apart."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit("w " * 10).alias("text"))
    shape = {"s0": [2.0, 0.0, 0.0], "s1": [0.0, 1.0, 0.0], "s2": [1.0, 1.0, 1.0]}
    pick = F.create_map(*(x for s, w in shape.items() for x in (F.lit(s), F.array(*map(F.lit, w)))))
    mixed = curriculum.mix(docs, lambda s: s.select("source", "source_size", pick[F.col("source")].alias("weights")), share=1.0)
    order = curriculum.training_order(mixed).join(mixed.select("doc_id", "source", "target"), "doc_id").collect()
    for source, w in shape.items():
        own = sorted((r["position"], r["words"]) for r in order if r["source"] == source)
        goal = next(r["target"] for r in order if r["source"] == source)
        for t in (0.25, 0.5, 0.75):
            area = sum((w[k] + (w[k + 1] - w[k]) * (x - k)) / 1000 for x in (i / 500 for i in range(int(t * 1000))) for k in [min(1, int(x))])
            whole = (w[0] + w[1]) / 4 + (w[1] + w[2]) / 4
            assert abs(sum(n for p, n in own if p <= t) - goal * area / whole) < 0.01 * goal + 20


def test_sums_by_buckets(spark, odd):
    sized = curriculum.sizes(odd, 1).cache()
    goals = curriculum.targets(curriculum.cycling([1.0], [1.0])(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), 1.5, 2).cache()
    a, b = (sorted(map(repr, curriculum.placed(sized, goals, 2, n).collect())) for n in (1, 37))
    assert a == b


def test_resampling(spark):
    from astroloom.llm import registry

    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute3.resampled([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in bench.collect()])
    assert sorted((tuple(r) for r in registry.queries()["op13_resampling"](spark, SF).collect()), key=repr) == want


@pytest.mark.parametrize(("longest", "percent", "least"), [(1, 10, 20), (2, 50, 2), (3, 100, 0)])
def test_resampling_of_odd_rows(spark, odd, longest, percent, least):
    target = spark.createDataFrame([("zebra two lamp",), (None,)], "text string")
    got = resampling.resample(odd, target, longest=longest, percent=percent, least_words=least).select("doc_id", "n_features", "weight", "score", "rank")
    want = brute3.resampled([(r[0], r[3]) for r in ODD], ["zebra two lamp", None], longest, percent=percent, least=least)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert resampling.resample(odd.limit(0), target).count() == 0
    assert resampling.resample(odd, target.limit(0)).count() == len(ODD)


def test_kth_key_of_wide_and_tied_keys(spark):
    values = [(5, -(2**63)), (5, 2**63 - 1), (5, 0), (-3, 7), (-3, 7), (-3, 8), (10**12, 1)]
    rows = spark.createDataFrame(values, "a long, b long").cache()
    for k in range(1, len(values) + 1):
        want = sorted(values)[k - 1]
        assert resampling.kth(rows, ["a", "b"], k) == (list(want), sum(v < want for v in values))
