"""The target recall of the n-gram Jaccard join, by all pairs of texts at the bound of similarity."""

from __future__ import annotations

import random

import pytest

from astroloom.llm import jaccard_join as J


def pairs_at_the_bound(n: int, size: int, seed: int) -> list[tuple[int, str]]:
    """2n texts; 2k and 2k+1 share at least 0.8 of their shingles, and few more."""
    r, docs = random.Random(seed), []
    for k in range(n):
        words = [f"w{k}x{r.randrange(10**6)}" for _ in range(size)]
        other, share = list(words), lambda a, b: len(a & b) / len(a | b)
        sets = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        while True:
            tried = list(other)
            tried[r.randrange(size)] += "y"
            if share(sets(words), sets(tried)) < 0.8:
                break
            other = tried
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    return docs


def test_more_recall_takes_more_runs():
    runs = [len(J.runs_for(x)) for x in (0.5, 0.9, 0.99, J.RECALL, 0.999999)]
    assert runs == sorted(runs) and runs[0] < runs[2] < runs[4]
    with pytest.raises(ValueError, match="between"):
        J.runs_for(1.0)


def test_a_target_is_reached(spark, monkeypatch):
    """With buckets so small that all pairs have to go down to the last level."""
    monkeypatch.setattr(J, "LIMIT", 1)
    docs = spark.createDataFrame(pairs_at_the_bound(400, 80, 3), "doc_id long, text string")
    found = {x: sum(r.doc_id % 2 == 1 and r.class_id == r.doc_id - 1 for r in J.near_duplicates(docs, recall=x).collect()) for x in (0.6, J.RECALL)}
    assert found[0.6] >= 0.6 * 400 * 0.9 and found[J.RECALL] >= 398
    assert found[0.6] < found[J.RECALL]


def test_exact_mode_asks_no_sketch(spark, monkeypatch):
    monkeypatch.setattr(J, "FEW", 0)
    monkeypatch.setattr(J, "AGREE", J.BINS + 1)  # no two sketches are alike enough
    docs = spark.createDataFrame(pairs_at_the_bound(20, 60, 5), "doc_id long, text string")
    assert all(r.n_links == 0 for r in J.near_duplicates(docs).collect())
    assert all(r.n_links == 1 for r in J.near_duplicates(docs, exact=True).collect())
