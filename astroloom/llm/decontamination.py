"""Benchmark decontamination by templates, in DataFrame operations only.

Words lose their punctuation; numbers, names (words with a capital first letter, and
pronouns of the third person) and units (after a number) become typed placeholders. Windows of five template
words are hash-joined: a document is a candidate for an item if it holds 0.8 or
more of the item's windows. Then the values in the placeholders are compared:
the item's values must map to the document's like a function in 0.8 or more of
the distinct pairs, so that a question with other names or numbers counts and a
chance meeting of function words doesn't. An exact copy maps each value to itself.
Both must hold within one occurrence: matches at one offset between item and
document, or at offsets that are joined over gaps of up to GAP words, of half the
item, or of any length. One occurrence that passes is a leak.

Inside a document's row, windows first pass a bit filter of fixed size made from
the benchmark; only those that pass become rows. The benchmark side is broadcast
after its windows are counted; beyond MAX_BROADCAST it is joined by a shuffle. Windows with fewer than three
words outside placeholders carry no evidence and are left out on both sides.
An item without a window is one window as a whole: with any numbers and units if
it has three other words, names being literal there. An item with fewer words of that kind counts
only where it is a whole line or sentence of a document, signs such as + and = being words. An item
without words or signs matches nothing.

The SQL twin pools the matches of a document and leaves such items out.

Defined results: null and empty texts hold no window and are clean; repeated
documents are judged one by one and repeated benchmark texts each count as an
item; an empty benchmark leaves all documents clean; an empty table gives no
rows; further columns, whatever their names, are kept by clean() and ignored
elsewhere; rows with equal or null ids are judged one by one; texts of any length
are one row's arrays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, discard, materialise, read

WORDS, SIMILARITY, LITERALS = 5, 0.8, 3
MAX_BROADCAST = 500_000
#: Offsets of one occurrence may differ by so much from one to the next, besides by none, half an item or anything.
GAP = 3
#: 64-bit words of the filter that windows pass before they become rows.
FILTER_WORDS = 2048
PUNCTUATION = ".,;:!?\"'`()[]{}|#*$%&<>=+~^_\\/"
#: Signs that stay in the lines and sentences which short items are compared with.
SIGNS = "+-*/=<>%^"
#: Words that count as names: capitalised ones, and pronouns that change with a name.
NAME = r"^(?:\p{Lu}|(?:s?he|they|him|her|them|his|hers|their|theirs|himself|herself|themselves)$)"
PRONOUNS = "he she they him her them his hers their theirs himself herself themselves".split()
UNITS = "mm cm m km in ft mi mg g kg t lb oz ml l s ms min h hour hours minute minutes second seconds day days week weeks month months year years km/h mph percent dollars euros cents degrees".split()


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), PUNCTUATION, ""), SPACE), lambda w: w != "")


def template(w: Column) -> Column:
    """Words with placeholders. w: a column of words. Most words begin with a to z; those are looked up in sets, and the patterns see the others."""

    def kind(x: Column, i: Column) -> Column:
        number = x.rlike(r"^[-+]?\p{N}")
        unit = x.isin(UNITS) & (i > 0) & F.coalesce(F.get(w, i - 1), F.lit("")).rlike(r"^[-+]?\p{N}")
        small = F.when(x.isin(PRONOUNS), F.lit("<name>")).when(unit, F.lit("<unit>")).otherwise(x)
        return F.when((x >= "a") & (x < "{"), small).when(number, F.lit("<number>")).when(x.rlike(NAME), F.lit("<name>")).otherwise(x)

    return F.transform(w, kind)


def codes(t: Column) -> Column:
    """A number for each template word: its hash but for the last bit, which tells literal words."""
    return F.transform(t, lambda x: F.shiftleft(F.xxhash64(x), 1).bitwiseOR(F.when(x.startswith("<"), F.lit(0)).otherwise(F.lit(1)).cast("long")))


def windows(c: Column, every: bool = False) -> Column:
    """Hash of the window at each position of codes(), null where too few of its words are literal, or with every never null: such a window equals none that has a hash."""

    def at(i: Column) -> Column:
        own = [F.get(c, i + k) for k in range(WORDS)]
        if every:
            return F.xxhash64(*own)
        literal = sum((x.bitwiseAND(F.lit(1)) for x in own[1:]), own[0].bitwiseAND(F.lit(1)))
        return F.when(literal >= LITERALS, F.xxhash64(*own))

    return F.when(F.size(c) >= WORDS, F.transform(F.sequence(F.lit(0), F.size(c) - WORDS), at)).otherwise(F.array().cast("array<bigint>"))


def _prepared(df: DataFrame, key: str, every: bool = False) -> DataFrame:
    """key, w, t and h of each row; w, t and the codes are read more than once so that they are computed once."""
    w = df.select(F.col(key), words(F.col("text")).alias("w"))
    t = w.select(key, "w", template(F.col("w")).alias("t")).select(key, "w", "t", codes(F.col("t")).alias("c"))
    return t.select(key, "w", "t", windows(F.col("c"), every).alias("h"))


def _windows(prepared: DataFrame, key: str, passes=None) -> DataFrame:
    """key, pos, h and the words in the placeholders of each window that passes.

    The outer form of explode: for the plain one Catalyst infers a filter on the
    array, pushes it below the projections and computes them again in each step."""
    wanted = lambda i: F.get("h", i).isNotNull() if passes is None else passes(F.get("h", i))
    at = F.when(F.size("h") > 0, F.filter(F.sequence(F.lit(0), F.size("h") - 1), wanted))
    slots = lambda i: F.array_compact(F.array(*(F.when(F.get("t", i + k).startswith("<"), F.get("w", i + k)) for k in range(WORDS))))
    found = prepared.select(key, "h", "t", "w", at.alias("at")).select(key, F.transform("at", lambda i: F.struct(i.alias("pos"), F.get("h", i).alias("h"), slots(i).alias("slots"))).alias("x"))
    return found.select(key, F.explode_outer("x").alias("x")).select(key, "x.pos", "x.h", "x.slots").where("h is not null")


def _filter(probe: DataFrame):
    """A test that all hashes in probe pass and most others don't: one bit for each, in FILTER_WORDS words whatever the size of probe."""
    word, bit = (F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(FILTER_WORDS - 1))).cast("int"), F.col("h").bitwiseAND(F.lit(63)).cast("int")
    held = {r[0]: r[1] for r in probe.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits")).collect()}
    bits = F.expr(f"array({','.join(f'cast({held.get(k, 0)} as bigint)' for k in range(FILTER_WORDS))})")
    return lambda h: F.getbit(F.get(bits, F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1


def _open(prepared: DataFrame) -> DataFrame:
    """prepared with o: its words, only numbers and units as placeholders."""
    return prepared.withColumn("o", F.transform(F.arrays_zip("w", "t"), lambda x: F.when(x.t.isin("<number>", "<unit>"), x.t).otherwise(x.w)))


def _slots(w: Column, o: Column) -> Column:
    return F.transform(F.filter(F.arrays_zip(w.alias("w"), o.alias("o")), lambda x: x.o.isin("<number>", "<unit>")), lambda x: x.w)


def segment(text: Column) -> Column:
    """A line or sentence without punctuation, but with signs, one blank between words."""
    bare = F.translate(text, "".join(c for c in PUNCTUATION if c not in SIGNS), "")
    return F.trim(F.regexp_replace(bare, SPACE, " "))


def _whole_items(items: DataFrame, texts: DataFrame) -> DataFrame:
    """item_id, item_pos, h, item_slots, n_windows, n_words and free of each item without windows: the item as one window with open numbers and units (free), or as a line."""
    bare = F.size(F.filter("h", lambda v: v.isNotNull())) == 0
    x = _open(items.where(bare)).withColumn("n_words", F.size("w"))
    free = F.size(F.filter("o", lambda v: ~v.isin("<number>", "<unit>"))) >= LITERALS
    open_ = x.where(free).select("item_id", F.xxhash64("n_words", F.lit(True), "o").alias("h"), _slots(F.col("w"), F.col("o")).alias("item_slots"), "n_words", F.lit(True).alias("free"))
    short = texts.select("item_id", segment(F.coalesce("text", F.lit(""))).alias("s"), words(F.col("text")).alias("w"))
    short = short.withColumn("t", template(F.col("w"))).where("s <> ''")
    short = _open(short.withColumn("h", windows(codes(F.col("t")))).where(bare)).where(~free)
    line = short.select("item_id", F.xxhash64(F.lit("line"), "s").alias("h"), F.array().cast("array<string>").alias("item_slots"), F.size("w").alias("n_words"), F.lit(False).alias("free"))
    return open_.unionByName(line).select("item_id", F.lit(0).alias("item_pos"), "h", "item_slots", F.lit(1).alias("n_windows"), "n_words", "free")


def _lines(docs: DataFrame, passes) -> DataFrame:
    """doc_id, pos, h and slots (none) of the lines and sentences that pass."""
    lines = F.split(F.coalesce("text", F.lit("")), "[\r\n]+")
    parts = F.flatten(F.transform(lines, lambda x: F.array_distinct(F.concat(F.array(x), F.split(x, r"(?<=[.!?])[\x20\x09-\x0D]+")))))
    hashed = F.transform(parts, lambda x: F.xxhash64(F.lit("line"), segment(x)))
    own = docs.select("doc_id", F.explode_outer(F.filter(F.transform(hashed, lambda h, i: F.struct(i.alias("pos"), h.alias("h"))), lambda x: passes(x.h))).alias("x")).where("x is not null")
    return own.select("doc_id", "x.pos", "x.h", F.array().cast("array<string>").alias("slots"))


def _runs(prepared: DataFrame, key: str, lengths: list[int], passes) -> DataFrame:
    """key, pos, h and slots of the runs of so many words that pass, as _whole_items makes them of free items."""
    own = _open(prepared)

    def found(n: int) -> Column:
        at = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n))
        run = F.transform(at, lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(n), F.lit(True), F.slice("o", i + 1, F.lit(n))).alias("h"), F.lit(n).alias("n")))
        return F.coalesce(F.filter(run, lambda r: passes(r.h)), F.array().cast("array<struct<pos:int,h:bigint,n:int>>"))

    own = own.select(key, "w", "o", F.explode_outer(F.concat(*(found(n) for n in lengths))).alias("x")).where("x is not null")
    return own.select(key, "x.pos", "x.h", _slots(F.slice("w", F.col("x.pos") + 1, F.col("x.n")), F.slice("o", F.col("x.pos") + 1, F.col("x.n"))).alias("slots"))


def _occurrences(found: DataFrame) -> DataFrame:
    """found (doc_id, item_id, n_windows, n_words, x: array of off, item_pos, pairs) as doc_id, item_id, n_windows, n_matched and pairs, a row for each way to join offsets and each run of them."""
    gaps = F.array(F.lit(0), F.lit(GAP), F.expr("n_words div 2").cast("int"), F.lit(None).cast("int"))
    each = found.withColumn("gap", F.explode(F.array_distinct(gaps))).select("doc_id", "item_id", "n_windows", "gap", F.explode("x").alias("x")).select("doc_id", "item_id", "n_windows", "gap", "x.*")
    order = Window.partitionBy("doc_id", "item_id", "gap").orderBy("off")
    starts = each.withColumn("new", (F.col("off") - F.lag("off").over(order) > F.col("gap")).cast("int"))
    runs = starts.withColumn("run", F.coalesce(F.sum("new").over(order), F.lit(0)))
    out = runs.groupBy("doc_id", "item_id", "gap", "run").agg(F.first("n_windows").alias("n_windows"), F.size(F.collect_set("item_pos")).alias("n_matched"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    return out.select("doc_id", "item_id", "n_windows", "n_matched", "pairs")


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows (of the item), n_matched (most in one occurrence that passes) and reparameterised (one that passes has other values), a row for each leak, as a table."""
    d = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    texts = benchmark.select("item_id", "text").dropDuplicates()
    items = _prepared(texts, "item_id")
    n_windows = F.size(F.filter("h", lambda x: x.isNotNull()))
    probe = _windows(items, "item_id").withColumnsRenamed({"pos": "item_pos", "slots": "item_slots"})
    probe = probe.join(items.select(F.col("item_id").alias("_i"), n_windows.alias("n_windows"), F.size("w").alias("n_words")).where("n_windows > 0"), F.col("item_id").eqNullSafe(F.col("_i"))).drop("_i")
    probe = table = materialise(probe.withColumn("free", F.lit(None).cast("boolean")).unionByName(_whole_items(items, texts)), "benchmark")
    whole = probe.where("free is not null").select(F.when(F.col("free"), F.col("n_words")).alias("n")).distinct().collect()  # at most a row for each length without a window
    lengths = sorted(r["n"] for r in whole if r["n"] is not None)
    probe = probe.drop("free")
    side = F.broadcast(probe) if probe.count() <= MAX_BROADCAST else probe
    passes, prepared = _filter(probe), _prepared(d, "doc_id", every=True)
    own = _windows(prepared, "doc_id", passes)
    if lengths:
        own = own.unionByName(_runs(prepared, "doc_id", lengths, passes))
    if len(whole) > len(lengths):
        own = own.unionByName(_lines(d, passes))
    met = own.join(side, "h")
    pairs = F.transform(F.arrays_zip("item_slots", "slots"), lambda p: F.struct(p.item_slots.alias("a"), p.slots.alias("b")))
    match = F.struct((F.col("pos") - F.col("item_pos")).alias("off"), "item_pos", pairs.alias("pairs"))
    both = met.groupBy("doc_id", "item_id").agg(F.first("n_windows").alias("n_windows"), F.first("n_words").alias("n_words"), F.collect_list(match).alias("x"))
    enough = F.col("n_matched") >= SIMILARITY * F.col("n_windows")
    both = _occurrences(both.withColumn("n_matched", F.size(F.array_distinct(F.transform("x", lambda m: m.item_pos)))).where(enough).drop("n_matched")).where(enough)
    values = F.size(F.array_distinct(F.transform("pairs", lambda p: p.a)))
    out = both.where(values >= SIMILARITY * F.size("pairs")).groupBy("doc_id", "item_id").agg(
        F.max("n_windows").cast("long").alias("n_windows"), F.max("n_matched").cast("long").alias("n_matched"), F.bool_or(F.exists("pairs", lambda p: p.a != p.b)).alias("reparameterised")
    )
    out = materialise(out, "leaks")
    discard(table)
    return out


def _row_key() -> Column:
    """A key of a row that tells texts under one id apart, and rows without an id."""
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))


def _by_row(docs: DataFrame) -> DataFrame:
    return docs.select(_row_key().alias("doc_id"), "text")


def by_document(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, items (ids in order, comma separated) and n_reparameterised of every row of docs."""
    leaks = find(_by_row(docs), benchmark).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"), F.count_if("reparameterised").alias("n_reparameterised")
    )
    # Leaked documents are few and the rest holds ids and hashes only; nothing here moves a text.
    own = docs.select("doc_id", _row_key().alias("_key"))
    out = own.join(leaks.withColumnRenamed("doc_id", "_key"), "_key", "left")
    return out.select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"), F.coalesce("n_reparameterised", F.lit(0)).alias("n_reparameterised")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated ones, all columns kept."""
    leak = f"_leak_{uuid.uuid4().hex}"  # no column of docs has this name
    leaks = find(_by_row(docs), benchmark).select(F.col("doc_id").alias(leak)).distinct()
    few = leaks.count() <= MAX_BROADCAST
    return docs.join(F.broadcast(leaks) if few else leaks, _row_key() == F.col(leak), "left_anti")


def op5_decontamination(spark, sf_dir) -> DataFrame:
    return by_document(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


OP5_SQL = r"""
WITH src AS (SELECT 'd' AS k, doc_id AS id, text FROM documents UNION ALL SELECT DISTINCT 'b', item_id, text FROM benchmark),
w AS (SELECT k, id, list_filter(string_split_regex(regexp_replace(coalesce(text, ''), '[.,;:!?"''`()\[\]{}|#*$%&<>=+~^_\\/]', '', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM src),
tok AS (SELECT k, id, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM w),
t AS (
  SELECT k, id, i, x, CASE WHEN regexp_matches(x, '^[-+]?\p{N}') THEN '<number>' WHEN regexp_matches(x, 'NAME') THEN '<name>'
         WHEN x IN (UNITS) AND regexp_matches(coalesce(lag(x) OVER o, ''), '^[-+]?\p{N}') THEN '<unit>' ELSE x END AS t
  FROM tok WINDOW o AS (PARTITION BY k, id ORDER BY i)),
win AS (
  SELECT * FROM (
    SELECT k, id, i, t || ' ' || lead(t, 1) OVER o || ' ' || lead(t, 2) OVER o || ' ' || lead(t, 3) OVER o || ' ' || lead(t, 4) OVER o AS g,
           sum(CASE WHEN starts_with(t, '<') THEN 0 ELSE 1 END) OVER (PARTITION BY k, id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS lit
    FROM t WINDOW o AS (PARTITION BY k, id ORDER BY i))
  WHERE g IS NOT NULL AND lit >= 3),
n AS (SELECT id, count(*) AS n_windows FROM win WHERE k = 'b' GROUP BY id),
m AS (SELECT a.id AS doc_id, b.id AS item_id, a.i AS pos, b.i AS item_pos FROM win a JOIN win b ON a.g = b.g WHERE a.k = 'd' AND b.k = 'b'),
c AS (SELECT doc_id, item_id FROM m JOIN n ON n.id = m.item_id GROUP BY doc_id, item_id, n_windows HAVING count(DISTINCT item_pos) >= 0.8 * n_windows),
p AS (
  SELECT DISTINCT m.doc_id, m.item_id, b.x AS a, d.x AS b
  FROM c JOIN m USING (doc_id, item_id) CROSS JOIN range(0, 5) r(j)
  JOIN t b ON b.k = 'b' AND b.id = m.item_id AND b.i = m.item_pos + r.j AND starts_with(b.t, '<')
  JOIN t d ON d.k = 'd' AND d.id = m.doc_id AND d.i = m.pos + r.j),
ok AS (
  SELECT c.doc_id, c.item_id, coalesce(bool_or(a <> b), false) AS re FROM c LEFT JOIN p USING (doc_id, item_id)
  GROUP BY c.doc_id, c.item_id HAVING count(DISTINCT a) >= 0.8 * count(a)),
agg AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS items, count(*) FILTER (WHERE re) AS nr FROM ok GROUP BY doc_id)
SELECT documents.doc_id, n IS NOT NULL AS contaminated, coalesce(n, 0) AS n_items, coalesce(items, '') AS items, coalesce(nr, 0) AS n_reparameterised
FROM documents LEFT JOIN agg USING (doc_id)
""".replace("UNITS", ", ".join(f"'{u}'" for u in UNITS)).replace("NAME", NAME)
