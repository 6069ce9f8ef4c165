"""Order of the cascade: rejections per cost among the rows still there; the order never changes the verdict."""

from __future__ import annotations


def test_order_counts_only_rows_that_are_left():
    from astroloom.llm.quality_rules import ordered

    rules = dict.fromkeys("abc")
    rejected = [(frozenset("ab"), 90), (frozenset("b"), 5), (frozenset("c"), 20), (frozenset(), 100)]
    assert ordered(rules, rejected, {"a": 1.0, "b": 1.2, "c": 1.0}) == ["a", "c", "b"]
    assert ordered(rules, rejected, {"a": 100.0, "b": 1.0, "c": 1.0}) == ["b", "c", "a"]
    assert ordered(rules, [], dict.fromkeys("abc", 1.0)) == ["a", "b", "c"]


def test_verdict_is_that_of_all_rules(spark):
    from astroloom.llm import quality_rules as Q

    texts = [None, "", "one two", "word " * 30, "SHOUT AT ALL OF YOU HERE NOW AND THEN SO " * 1, "1 22 333 4444 55 66 77 88 99 100 11", "plain words stand here in a row and say some thing new", "wow! " + "! " * 40, "a b c d e f g h i j k l m"]
    docs = spark.createDataFrame([(i if i != 3 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    stats = Q.text_stats(docs)
    rules = Q.default_rules()
    any_rule = Q.base_failed()
    for c in rules.values():
        any_rule = any_rule | c
    want = {(r[0], r[1]): r[2] for r in stats.select("doc_id", "text", ~any_rule).collect()}
    got = {(r.doc_id, r.text): r.kept for r in Q.cascade(stats, Q.text_stats(Q.sampled(docs, 5))).collect()}
    assert got == want and set(got.values()) == {True, False}
    assert Q.cascade(Q.text_stats(docs.limit(0)), Q.text_stats(docs.limit(0))).count() == 0
    # The base columns by plain counting.
    import re

    for r in stats.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        lines = [x for x in r.text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        at = {}
        for i in range(len(w) - 4):
            at.setdefault(tuple(w[i : i + 5]), []).append(i)
        again = {p + k for own in at.values() if len(own) > 1 for p in own for k in range(5)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text)), len(lines) - len(set(lines)), len(again))
