"""Templates and windows of op5: words looked up in sets follow the patterns, and windows by codes are as literal as their words."""

from __future__ import annotations

from pyspark.sql import functions as F

from astroloom.llm import decontamination as d

WORDS = "7 km She he shepherd them Ünder über -3 kg +4.5 kg kg ½ hours km/h 60 km/h THEY they zebra ~a {x éclair 3 Km 9 days theirs x1 1x".split()


def test_templates_follow_the_patterns(spark):
    number, units = r"^[-+]?\p{N}", F.array(*(F.lit(u) for u in d.UNITS))
    w = spark.createDataFrame([(WORDS,)], "w array<string>")
    before = lambda i: F.coalesce(F.get("w", i - 1), F.lit("")).rlike(number) & (i > 0)
    plain = lambda x, i: F.when(x.rlike(number), "<number>").when(x.rlike(d.NAME), "<name>").when(before(i) & F.array_contains(units, x), "<unit>").otherwise(x)
    got, want = w.select(d.template(F.col("w")), F.transform("w", plain)).first()
    assert got == want and got.count("<unit>") == 6 and {"<number>", "<name>"} < set(got)


def test_windows_without_enough_literal_words_have_a_hash_only_on_request(spark):
    t = spark.createDataFrame([(["a", "b", "c", "<name>", "<number>", "<unit>", "d"],)], "t array<string>")
    some, every = t.select(d.windows(d.codes(F.col("t"))), d.windows(d.codes(F.col("t")), True)).first()
    assert some[0] == every[0] and some[1:] == [None, None] and None not in every and len(set(every)) == 3
