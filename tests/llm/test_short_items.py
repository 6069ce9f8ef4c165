"""Benchmark items of a few words, signs, and pronouns that change with a name."""

from __future__ import annotations

ITEMS = [(1, "Paris"), (2, "2 + 2 = ?"), (3, "?!"), (4, None), (5, "When Anna reached the market she bought seven red apples and gave three of them away."), (6, "How many moons has Mars?")]
DOCS = [
    (1, "We flew to Paris in May and stayed there."),
    (2, "The final score was 2, 2 after extra time."),
    (3, "Question: name it.\nParis.\nNext one."),
    (4, "A warm-up. 2 + 2 = ? Now the next."),
    (5, "2 - 2 = ?"),
    (6, "Well then. When Anton reached the market he bought seven red apples and gave three of them away. Then he slept."),
    (7, "How many moons has Mars? Two."),
    (8, None),
    (9, "?! ..."),
    (10, "Then she bought some apples at the market and gave them away, all of them red."),
]


def test_short_items_and_pronouns(spark):
    from astroloom.llm import decontamination

    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: r["items"] for r in decontamination.by_document(docs, items).collect() if r["contaminated"]}
    assert got == {3: "1", 4: "2", 6: "5", 7: "6"}
    assert {r["doc_id"] for r in decontamination.clean(docs, items).collect()} == {1, 2, 5, 8, 9, 10}
