"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Statistics of a text are built with array functions inside its row, so there is
no shuffle at all. The rules that follow the base rule form one CASE WHEN: a row
stops at its first rejection. Their order comes from a sample of SAMPLE_ROWS rows
or so, drawn before any statistics are computed: the rule with most rejections per
second among the rows that the rules before it, and the base rule, let through
comes next. The verdict is a conjunction, hence the order changes the cost of a
run and never its result. The statistics that are returned have to be computed for
every row, so what the cascade saves are the rules that look at the text again.

Defined results: a null or empty text has no words and fails the base rule;
ties and repeated rows are judged row by row; an empty table gives no rows and
keeps the order in which the rules were given; further columns are ignored; a
text of any length is one row's arrays.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, words_of

#: Rows of the sample on which cost and selectivity are estimated, on average, and how often each rule is timed.
SAMPLE_ROWS, TIMES = 2000, 3
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]+"


def _without(text: Column, pattern: str) -> Column:
    """text without what matches; much cheaper than translate, which looks each character up in a map of strings."""
    return F.regexp_replace(text, pattern, "")


def _repeat_words(h: Column) -> Column:
    """Positions under windows whose hash occurs twice or more; h: the hash of the window at each position."""

    def covered(pos: Column) -> Column:
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(pos, zero, lambda a, p: F.struct(p.alias("last"), (a.n + F.least(F.lit(WINDOW), p - a["last"])).alias("n")), lambda a: a.n)

    def repeated(s: Column) -> Column:
        n = F.size(s)
        same = lambda x, i: ((i > 0) & (F.get(s, i - 1).h == x.h)) | ((i < n - 1) & (F.get(s, i + 1).h == x.h))
        return covered(F.sort_array(F.transform(F.filter(s, same), lambda x: x.p)))

    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, repeated))


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id, text and the base statistics of the text. Windows are compared by 64-bit hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = docs.select("doc_id", text.alias("text"), words_of(F.col("text")).alias("_w"))
    n = F.size("_w")
    beside = F.arrays_zip(*(F.slice("_w", k + 1, n - WINDOW + 1) for k in range(WINDOW)))
    windows = F.when(n >= WINDOW, F.transform(beside, lambda x: F.xxhash64(x))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(_without(x, SPACE)) > 0)
    hashed = bare.select("doc_id", "text", n.cast("long").alias("n_words"), windows.alias("_h"), lines.alias("_l"))
    return hashed.select(
        "doc_id",
        "text",
        "n_words",
        F.length(_without(F.col("text"), SPACE)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_h")).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def default_rules() -> dict[str, Column]:
    """Name and condition of rejection. Bounds are wide: clean prose of any language passes."""
    count = lambda pattern: F.length("text") - F.length(_without(F.col("text"), pattern))
    return {
        "symbols": F.col("n_symbols") * 10 > F.col("word_chars"),
        "dup_lines": F.col("n_dup_lines") * 10 > F.col("n_lines") * 3,
        "short_words": F.col("word_chars") < F.col("n_words") * 2,
        "long_words": F.col("word_chars") > F.col("n_words") * 25,
        "exclamation": count("!+") * 10 > F.col("word_chars"),
        "shouting": count("[A-Z]+") * 2 > F.col("word_chars"),
        "digits": count("[0-9]+") * 2 > F.col("word_chars"),
    }


def sampled(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About `rows` rows of docs, each with the same chance, so no id or source weighs more than its share."""
    n = docs.count()
    return docs.sample(min(1.0, rows / n), 7) if n > rows else docs


def measure(stats: DataFrame, rules: dict[str, Column]) -> tuple[list[tuple[frozenset, int]], dict[str, float]]:
    """On the statistics of a sample: which sets of rules reject how many rows that pass the base rule, and the seconds of each rule.

    Each rule is timed several times and the least time over that of a plain count is taken, as first runs compile code."""
    sample = stats.persist()
    try:

        def seconds(what: Column) -> float:
            took = []
            for _ in range(TIMES):
                began = time.perf_counter()
                sample.select(F.count_if(what)).collect()
                took.append(time.perf_counter() - began)
            return min(took)

        flags = [F.coalesce(c, F.lit(False)).alias(f"r{k}") for k, c in enumerate(rules.values())]
        found = sample.where(~base_failed()).select(*flags).groupBy(*(f"r{k}" for k in range(len(rules)))).count().collect()
        names, plain = list(rules), seconds(F.col("n_words") > 0)
        cost = {name: max(seconds(c) - plain, 1e-4) for name, c in rules.items()}
        return [(frozenset(names[k] for k in range(len(names)) if r[k]), r["count"]) for r in found], cost
    finally:
        sample.unpersist()


def ordered(rules: dict[str, Column], rejected: list[tuple[frozenset, int]], cost: dict[str, float]) -> list[str]:
    """Greedy: by rejections per second among the rows still there, best first; equal ones in the order given."""
    left, out = list(rules), []
    while left:
        gain = {r: sum(n for own, n in rejected if r in own) / cost[r] for r in left}
        best = max(left, key=lambda r: gain[r])
        out.append(best)
        left.remove(best)
        rejected = [(own, n) for own, n in rejected if best not in own]
    return out


def cascade(stats: DataFrame, sample: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Add base_failed and kept. sample: the statistics of some of the rows."""
    rules = default_rules() if rules is None else rules
    order = ordered(rules, *measure(sample, rules)) if rules else []
    kept = F.when(F.col("base_failed"), F.lit(False))
    for name in order:
        kept = kept.when(rules[name], F.lit(False))
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", kept.otherwise(F.lit(True)))


def op3_quality_rules(spark, sf_dir) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    out = cascade(text_stats(docs), text_stats(sampled(docs)))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
s AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS n_lines,
         length(text) - length(regexp_replace(text, '!', '', 'g')) AS ex,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS up,
         length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS dig
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols * 10 > word_chars OR n_dup_lines * 10 > n_lines * 3
            OR word_chars < n_words * 2 OR word_chars > n_words * 25 OR ex * 10 > word_chars OR up * 2 > word_chars OR dig * 2 > word_chars) AS kept
FROM s
"""
