"""Source divergence audit: which sources of a language use other words than the rest, and which words set a source apart.

Two passes with a vocabulary automaton. The first counts exactly in how many documents of its
language each term stands; terms in few documents go. The second builds, for every batch of texts, an Aho-Corasick
automaton of those kept terms that the batch holds, with a delimiter on both sides of each, and counts all occurrences by source.
An automaton holds what one batch holds at most, so its size follows the batch and not the vocabulary of the corpus.

The counts are sparse: a term's posting lists only the sources that have it. A pair's sum over all kept terms is the sum
that two sources without any term would have, plus what the terms of either change alone (from how many terms have a count),
plus a correction for the terms that both have. Only the last looks at pairs, in numpy, and leaves a task as one sum for each pair.

Shares are whole numbers: p = 1 + floor(10^9 (count + 1) / (N + V)). All arithmetic is on 64-bit integers and exact: (p - q)^2 stays
under 1.01 * 10^18, and no sum of floor((p - q)^2 / q) passes 4.1 * 10^18, as shares of a group sum to 10^9 and V at most.

Defined results: a null text, lang or source is ''; every row is a document of its own, repeated rows and ids included; equal
values rank by item in the order of UTF-8 bytes; a language without kept terms has pairs of value 0 and no terms; an empty table
gives an empty result. Columns beyond lang, source and text are not read. Very long texts are whole in one batch, which holds them alone.
What grows: the sources of one language stand in one row (a posting, the shares of absent terms), as the result has a row for each pair of them.
"""

from __future__ import annotations

import string
from operator import itemgetter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, discard, materialise, read, spread, to_batches

#: Bytes of text in a batch, whose terms make one automaton for each language.
BATCH_BYTES = 32_000_000
#: Bytes of texts that are scanned as one string.
JOINED = 1_000_000
#: Documents of its language that a kept term needs.
LEAST_DOCS = 3
#: Ranks reported of a source's own terms.
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Pairs that are computed at a time, and sums of pairs that a task holds before it hands them on.
PAIRS_AT_ONCE = 1_000_000

_LETTERS = string.ascii_letters.encode()
_TABLE = bytes((b | 0x20 if b < 0x80 else b) if b >= 0x80 or b in _LETTERS else 0x20 for b in range(256))


def padded(text: str | None) -> bytes:
    """The text as UTF-8 with A-Z lowered, every character that is no part of a term a blank, and a blank at both ends."""
    return b" " + (text or "").encode("utf-8", "surrogatepass").translate(_TABLE) + b" "


def terms_seen(texts: DataFrame) -> DataFrame:
    """batch, lang, term and in how many of the batch's documents of that language it stands. texts: bucketed by batch."""

    def count(table):
        from collections import Counter

        import pyarrow as pa

        found: dict[str, Counter] = {}
        for lang, text in zip(table.column("lang").to_pylist(), table.column("text"), strict=True):
            found.setdefault(lang, Counter()).update(set(padded(text.as_py()).split()))
        rows = [(lang, own) for lang, own in found.items() if own]
        n = sum(len(own) for _, own in rows)
        langs = [lang for lang, own in rows for _ in range(len(own))]
        names = pa.array([t for _, own in rows for t in own], pa.binary()).cast(pa.string())
        batch = table.column("batch")[0].as_py() if len(table) else 0
        return pa.table({"batch": pa.array([batch] * n, pa.int64()), "lang": pa.array(langs, pa.string()), "term": names, "n": pa.array([v for _, own in rows for v in own.values()], pa.int64())})

    return texts.groupBy("batch").applyInArrow(count, "batch long, lang string, term string, n long")


def by_source(rows):
    """Pairs of a source and padded texts of it in one string, which ends with the text that brings it to JOINED bytes."""
    held: dict[str, list] = {}
    sizes: dict[str, int] = {}
    for source, text in zip(rows.column("source").to_pylist(), rows.column("text"), strict=True):
        own = padded(text.as_py())
        held.setdefault(source, []).append(own)
        sizes[source] = sizes.get(source, 0) + len(own)
        if sizes[source] >= JOINED:
            yield source, b"".join(held.pop(source)).decode("utf-8", "surrogatepass")
            sizes[source] = 0
    for source, parts in held.items():
        yield source, b"".join(parts).decode("utf-8", "surrogatepass")


def recounted(texts: DataFrame, known: DataFrame) -> DataFrame:
    """lang, source, term and its occurrences, by batch: one automaton for each batch and language, over padded terms.

    texts: bucketed by batch, so that only the terms move. known: the kept terms that each batch holds, as batch, lang, term."""

    def scan(table, own):
        import ahocorasick
        import pyarrow as pa
        import pyarrow.compute as pc

        parts = [pa.table({c: pa.array([], t) for c, t in (("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()))})]
        for lang in pc.unique(own.column("lang")).to_pylist():  # one automaton at a time
            names = own.filter(pc.equal(own.column("lang"), lang)).column("term").combine_chunks()
            machine = ahocorasick.Automaton()
            for k, term in enumerate(names.to_pylist()):
                machine.add_word(f" {term} ", k)
            machine.make_automaton()
            rows = table.filter(pc.equal(table.column("lang"), lang))
            counts: dict[str, np.ndarray] = {}
            for source, text in by_source(rows):
                at = np.fromiter(map(itemgetter(1), machine.iter(text)), np.int64)
                held = counts.setdefault(source, np.zeros(len(names), np.int64))
                held += np.bincount(at, minlength=len(held))
            for source, held in counts.items():
                at = np.flatnonzero(held)
                parts.append(pa.table({"lang": pa.array([lang] * len(at), pa.string()), "source": pa.array([source] * len(at), pa.string()), "term": names.take(pa.array(at)), "n": pa.array(held[at])}))
        return pa.concat_tables(parts)

    return texts.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(scan, "lang string, source string, term string, n long")


def share(n: str, total: str) -> Column:
    """1 + floor(10^9 (n + 1) / total), as long division by three digits at a time, so that no product leaves 64 bits."""
    whole, rest = f"(({n} + 1L) div {total})", f"(({n} + 1L) % {total})"
    terms = [f"1L + {whole} * {SCALE}L"]
    for unit in (1_000_000, 1000, 1):
        terms.append(f"({rest} * 1000L div {total}) * {unit}L")
        rest = f"({rest} * 1000L % {total})"
    return F.expr(" + ".join(terms))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _summed(lang: str, keys: np.ndarray, values: np.ndarray, width: int):
    """One row for each pair of sources: lang, a, b, value."""
    import pyarrow as pa

    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    sums, keys = (np.add.reduceat(values, at) if len(at) else values), keys[at]
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys // width), pa.array(keys % width), pa.array(sums)], names=["lang", "a", "b", "value"])


PAIR = "lang string, a long, b long, value long"


def common_terms(postings: DataFrame) -> DataFrame:
    """For pairs of sources (a, b): what the terms of both add to what each changes alone; sums of each task."""

    def pairs(stream):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                width = max(w for _, _, _, w in parts)
                keys = np.concatenate([a * width + b for a, b, _, _ in parts])
                yield _summed(lang, keys, np.concatenate([v for _, _, v, _ in parts]), width)
            held.clear()

        for batch in stream:
            langs = np.array(batch.column("lang").to_pylist(), object)
            lists = batch.column("own")
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            gid, p, zero = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            first = np.cumsum(lengths) - lengths
            entry_first, entry_length = np.repeat(first, lengths), np.repeat(lengths, lengths)
            entry_lang = np.repeat(langs, lengths)
            for lang in dict.fromkeys(langs.tolist()):
                mine = np.flatnonzero(entry_lang == lang)
                block = (np.cumsum(entry_length[mine]) - entry_length[mine]) // PAIRS_AT_ONCE
                for own in np.split(mine, np.flatnonzero(np.diff(block)) + 1):
                    x = np.repeat(own, entry_length[own])
                    y = spread(entry_first[own], entry_length[own])
                    x, y = x[gid[x] != gid[y]], y[gid[x] != gid[y]]
                    if not len(x):
                        continue
                    value = _f(p[x], p[y]) - _f(p[x], zero[y]) - _f(zero[x], p[y]) + _f(zero[x], zero[y])
                    width = int(gid.max()) + 1
                    part = _summed(lang, gid[x] * width + gid[y], value, width)
                    held.setdefault(lang, []).append((*(part.column(k).to_numpy() for k in (1, 2, 3)), width))
                    size += part.num_rows
                    if size > PAIRS_AT_ONCE:
                        yield from flush()
                        size = 0
        yield from flush()

    return postings.select("lang", F.transform("own", lambda x: F.struct(x.gid, x.p, x.zero)).alias("own")).mapInArrow(pairs, PAIR)


def single_terms(groups: DataFrame) -> DataFrame:
    """For every ordered pair of sources: the sum over all kept terms as if no term stood in both.

    groups: lang, gid, zero (its share of an absent term), vocabulary, p and times (how many of its terms have which share), zeros (zero of all sources of the language, by gid)."""

    def pairs(stream):
        import pyarrow as pa

        for batch in stream:
            for r in batch.to_pylist():
                zeros, p, times = (np.array(r[k], np.int64) for k in ("zeros", "p", "times"))
                left, right = np.zeros(len(zeros), np.int64), np.zeros(len(zeros), np.int64)
                step = max(1, PAIRS_AT_ONCE // max(1, len(zeros)))
                plain, back = _f(np.int64(r["zero"]), zeros), _f(zeros, np.int64(r["zero"]))
                for k in range(0, len(p), step):
                    own, n = p[k : k + step, None], times[k : k + step, None]
                    left += ((_f(own, zeros[None]) - plain[None]) * n).sum(axis=0)
                    right += ((_f(zeros[None], own) - back[None]) * n).sum(axis=0)
                other = np.flatnonzero(np.arange(len(zeros)) != r["gid"])
                a = np.full(len(other), r["gid"], np.int64)
                value = np.concatenate([left[other] + r["vocabulary"] * plain[other], right[other]])
                yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * (2 * len(other)), pa.string()), pa.array(np.r_[a, other]), pa.array(np.r_[other, a]), pa.array(value)], names=["lang", "a", "b", "value"])

    return groups.mapInArrow(pairs, PAIR)


def counts_of(docs: DataFrame, least_docs: int, batch_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Occurrences of kept terms by lang, source and term, and vocabulary by lang; both as tables."""
    texts = bucketed(to_batches(docs, batch_bytes).drop("size"), "divergence_texts", "batch")
    seen = materialise(terms_seen(texts), "divergence_seen")
    kept = materialise(seen.groupBy("lang", "term").agg(F.sum("n").alias("docs")).where(F.col("docs") >= least_docs).select("lang", "term"), "divergence_kept")
    known = seen.join(kept, ["lang", "term"]).select("batch", "lang", "term")
    counts = materialise(recounted(texts, known).groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "divergence_counts")
    sizes = materialise(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary")), "divergence_sizes")
    for table in (texts, seen, kept):
        discard(table)
    return counts, sizes


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """lang, source, part, item, value, rank, and for terms n, p and q: the term's occurrences in the source, its share there and in the language."""
    docs = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts, sizes = counts_of(docs, least_docs, batch_bytes)
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    named = named.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("vocabulary", F.lit(0)).alias("vocabulary"))
    named = named.withColumn("zero", F.when(F.col("vocabulary") > 0, share("0L", "(total + vocabulary)")).otherwise(1))
    named = named.withColumn("gid", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long"))
    groups = materialise(named, "divergence_groups")

    shares = counts.join(groups, ["lang", "source"]).withColumn("p", share("n", "(total + vocabulary)"))
    entry = F.struct("gid", "p", "zero", "source", "n")
    postings = shares.groupBy("lang", "term", "vocabulary").agg(F.sum("n").alias("count"), F.collect_list(entry).alias("own"))
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.transform(F.array_sort(F.collect_list(F.struct("gid", "zero"))), lambda x: x.zero).alias("zeros"))
    postings = materialise(postings.join(whole.select("lang", "total"), "lang").select("lang", "term", "own", share("count", "(total + vocabulary)").alias("q")), "divergence_postings")

    entries = postings.select("lang", "term", "q", F.explode("own").alias("e")).select("lang", "term", "q", "e.*")
    alike = entries.groupBy("lang", "gid", "p").agg(F.count(F.lit(1)).alias("times")).groupBy("lang", "gid")
    alike = alike.agg(F.collect_list(F.struct("p", "times")).alias("own")).select("lang", "gid", F.col("own.p").alias("p"), F.col("own.times").alias("times"))
    none = F.array().cast("array<bigint>")
    rows = groups.join(alike, ["lang", "gid"], "left").join(whole.select("lang", "zeros"), "lang")
    alone = single_terms(rows.select("lang", "gid", "zero", "vocabulary", F.coalesce("p", none).alias("p"), F.coalesce("times", none).alias("times"), "zeros"))
    sums = alone.unionByName(common_terms(postings)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    name = lambda key, out: groups.select("lang", F.col("gid").alias(key), F.col("source").alias(out))
    pairs = sums.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    empty = F.lit(None).cast("long")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"), empty.alias("n"), empty.alias("p"), empty.alias("q"))
    own = entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"), "n", "p", "q")
    own = own.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)
    out = materialise(pairs.unionByName(own), "divergence")
    for table in (counts, sizes, groups, postings):
        discard(table)
    return out


def op11_divergence(spark, sf_dir) -> DataFrame:
    return audit(read(spark, sf_dir, "documents", "lang", "source", "text")).select("lang", "source", "part", "item", "value", "rank")


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
tok AS MATERIALIZED (SELECT id, lang, source, unnest(t) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT + coalesce(any_value(v.v), 0) AS d FROM g LEFT JOIN c USING (lang, source) LEFT JOIN v USING (lang) GROUP BY g.lang, g.source),
ln AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 1) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v))::HUGEINT AS q FROM c JOIN v USING (lang) GROUP BY lang, term),
p AS MATERIALIZED (
  SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // gn.d AS p
  FROM gn JOIN kept k USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p JOIN ln USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (FROM pair UNION ALL FROM term) QUALIFY part = 'pair' OR rank <= 200
"""
