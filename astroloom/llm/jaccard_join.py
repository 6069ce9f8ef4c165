"""Near-duplicate documents by chosen paths over shingles of five words.

1. Each text becomes the set of its five-word shingles (a shorter text: one
   shingle of all its words), a signature of that set, and a sketch with the
   least hash in each of 128 bins (an empty bin: of the set under a hash of its own). Documents with equal sets are one class;
   from here on only the class's smallest id takes part.
2. Chosen path: a run samples sketch positions; documents that agree at a
   sampled position share a bucket. Buckets of up to LIMIT documents are compared
   by brute force on the sketches, larger ones split again on positions sampled
   for that bucket. After LEVELS levels what is still large is compared in pairs of
   chunks, each a group of its own: exact, and no group grows.
   Runs are repeated until a pair of similarity 0.8 is found with the target recall (runs_for); more similar pairs are found more often.
3. A pair belongs to the least node that both documents reached, and is looked at
   there alone. Buckets name the documents that have such a pair with sketches
   alike or under FEW shingles; their exact sets go to the bucket, which verifies its pairs and returns
   for each document the number of its links and the least document that
   it is connected with there. So pairs never become rows, and what moves
   follows the documents and not the square of a group. With exact=True every pair that shares a bucket and could be similar by size is verified, whatever the sketches.
4. Groups are the connected components of what the buckets return, by least ids
   and pointer jumping over tables in the shared folder.

Result: a row for each document with class_id (least id of its group of near
duplicates), copy_of (least id with the same set) and n_links (other documents
with similarity 0.8 or more, copies included).

Defined results: null and empty texts have the empty set and are copies of one
another; a null doc_id is left alone (its own group, no links); of repeated
ids with different texts each takes part under that id; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blobs, discard, materialise, mixed, partitions, powers, prefix_hash, read, span_hash, spread, text_parts, utf8

WORDS, SIMILARITY = 5, 0.8
BINS, LEVELS, LIMIT = 128, 3, 200
#: Runs are repeated until a pair at the bound is found with this probability.
RECALL = 0.9995
#: Documents and shingles in a chunk of a bucket that stays large: a document is sent out once for each chunk, so few large ones move less.
CHUNK, CHUNK_SHINGLES = 1000, 1_000_000
#: Documents compared at once within a group, so that arrays stay small.
BLOCK = 250
#: Share of positions sampled at a node: 1 / (similarity * BINS).
SHARE = 1 / (SIMILARITY * BINS)
#: Pairs of sets of FEW shingles or more whose sketches agree in fewer positions than AGREE aren't verified; 4.5 standard deviations under the similarity.
FEW = 300
AGREE = int(BINS * (SIMILARITY - 4.5 * (SIMILARITY * (1 - SIMILARITY) / BINS) ** 0.5))

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def shingles(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each distinct shingle, by text and hash. raw: the bytes of texts of these lengths, one after the other."""
    lengths = lengths + 1
    buf = np.full(len(raw) + len(lengths), 10, np.uint8)  # a line feed ends each text
    inner = np.ones(len(buf), bool)
    inner[np.cumsum(lengths) - 1] = False
    buf[inner] = raw
    n_texts = len(lengths)
    blank = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    h = prefix_hash(buf)
    word = mixed(span_hash(h, start, end))
    doc = np.searchsorted(np.cumsum(lengths), start, "right")
    base = prefix_words(word)
    n = np.bincount(doc, minlength=n_texts)
    first = np.cumsum(n) - n
    many = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    at = spread(first, many)
    own = np.repeat(np.arange(n_texts), many)
    sh = mixed(span_hash(base, at, at + np.minimum(n, WORDS)[own]))
    order = np.lexsort((sh, own))
    own, sh = own[order], sh[order]
    new = np.concatenate(([True], (own[1:] != own[:-1]) | (sh[1:] != sh[:-1]))) if len(sh) else np.zeros(0, bool)
    return own[new], sh[new]


def prefix_words(word: np.ndarray) -> np.ndarray:
    """Like prefix_hash, over the hashes of words."""
    out = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * powers(len(word) + 1)[0][: len(word)], out=out[1:])
    return out


def sketches(own: np.ndarray, sh: np.ndarray, n_texts: int) -> np.ndarray:
    """Least hash in each bin for each text, as 32-bit numbers; an empty bin takes the least hash of the whole set under a hash of its own.

    So each position agrees with the probability of the similarity, and in short texts, too, one by one."""
    out = np.zeros((n_texts, BINS), np.uint32)
    filled = np.zeros((n_texts, BINS), bool)
    bin_ = (sh >> np.uint64(57)).astype(np.int64)
    new = np.concatenate(([True], (own[1:] != own[:-1]) | (bin_[1:] != bin_[:-1]))) if len(sh) else np.zeros(0, bool)
    out[own[new], bin_[new]] = mixed(sh[new]).astype(np.uint32)
    filled[own[new], bin_[new]] = True
    n = np.bincount(own, minlength=n_texts)
    first = np.cumsum(n) - n
    text, bin_ = np.nonzero(~filled & (n > 0)[:, None])
    salt = mixed(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    part = np.cumsum(n[text]) // 1_000_000  # so that temporary arrays stay small
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(text)]))
    for k, end in zip(cuts[:-1], cuts[1:], strict=True):
        t, b = text[k:end], bin_[k:end]
        if len(t):
            h = mixed(sh[spread(first[t], n[t])] ^ np.repeat(salt[b], n[t]))
            out[t, b] = np.minimum.reduceat(h, np.cumsum(n[t]) - n[t]).astype(np.uint32)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, a and b (signature of the set), n (its size) and sketch."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_parts(batch):
                own, sh = shingles(*utf8(part.column("text")))
                k = part.num_rows
                a, b = np.zeros(k, np.uint64), np.zeros(k, np.uint64)
                np.add.at(a, own, sh)
                np.add.at(b, own, mixed(sh ^ np.uint64(0x5851F42D4C957F2D)))
                sk = sketches(own, sh, k).view(np.int32)
                sketch = pa.ListArray.from_arrays(np.arange(0, k * BINS + 1, BINS, dtype=np.int32), pa.array(sk.ravel()))
                yield pa.record_batch({"doc_id": part.column("doc_id").cast("int64"), "a": a.view(np.int64), "b": b.view(np.int64), "n": np.bincount(own, minlength=k).astype(np.int32), "sketch": sketch})

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, a long, b long, n int, sketch array<int>")


# ---- chosen path ---------------------------------------------------------------------------


def _sampled(node: Column) -> Column:
    """Positions that a node samples, each with probability SHARE."""
    return F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.pmod(F.xxhash64(node, i), F.lit(1_000_000)) < int(SHARE * 1_000_000))


def runs_for(recall: float) -> list[np.ndarray]:
    """The root positions of each run, as many runs as a pair of similarity SIMILARITY needs to be found with the given probability.

    A pair meets below a node if it agrees at a sampled position and meets again below that one, LEVELS times in all: the survival of a
    branching process with 1 child on average. Runs that sample a position again share its agreement, so positions count
    once with the number of their tries. Where buckets stay small the pair is found sooner, so this is a lower bound, up to the sampling of the sketch."""
    if not 0 < recall < 1:
        raise ValueError("recall must lie between 0 and 1")
    below = 1.0
    for _ in range(LEVELS - 1):
        below = 1 - (1 - SHARE * SIMILARITY * below) ** BINS
    rng, tries, out, missed = np.random.default_rng(7), np.zeros(BINS, np.int64), [], 1.0
    while missed > 1 - recall:
        out.append(np.flatnonzero(rng.random(BINS) < SHARE))
        tries[out[-1]] += 1
        missed = float(np.prod(1 - SIMILARITY * (1 - (1 - below) ** tries)))
    return out


def buckets(reps: DataFrame, recall: float = RECALL) -> tuple[DataFrame, list[DataFrame]]:
    """key, node, side, doc and a of all final buckets of two documents or more, and the tables behind them. reps: doc, a, n, sketch.

    side is 0 where all pairs of the bucket count, else 1 or 2, and only pairs of both sides do."""
    first = [(r, int(i)) for r, positions in enumerate(runs_for(recall)) for i in positions]
    keys = F.array(*(F.xxhash64(F.lit(r), F.lit(i), F.get("sketch", F.lit(i))) for r, i in first))
    rows = reps.where("n > 0").select("doc", "a", "n", F.explode_outer(keys).alias("key")).where("key is not null")
    done, tables = [], []
    small = (F.col("size") <= LIMIT) & (F.col("weight") <= 2 * CHUNK_SHINGLES)
    for level in range(1, LEVELS + 1):
        count = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight")).where("size > 1")
        sized = materialise(rows.join(count, "key"), f"level{level}")
        tables.append(sized)
        done.append(sized.where(small).select("key", F.col("key").alias("node"), F.lit(0).alias("side"), "doc", "a"))
        large = sized.where(~small)
        if level == LEVELS:
            g = F.greatest(F.ceil(F.col("size") / CHUNK), F.ceil(F.col("weight") / CHUNK_SHINGLES)).cast("int")
            mine = F.pmod(F.xxhash64("doc", "key"), F.col("g")).cast("int")
            dealt = large.withColumn("g", g).withColumn("c", mine).select("key", "doc", "a", "c", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("o"))
            side = F.when(F.col("c") == F.col("o"), 0).when(F.col("c") < F.col("o"), 1).otherwise(2)
            done.append(dealt.select(F.xxhash64("key", F.least("c", "o"), F.greatest("c", "o")).alias("key"), F.col("key").alias("node"), side.alias("side"), "doc", "a"))
        elif large.isEmpty():
            break
        else:
            deeper = large.select("key", "doc", "a").join(reps.select("doc", "a", "n", "sketch"), ["doc", "a"])
            nxt = F.transform(_sampled(F.col("key")), lambda i: F.xxhash64("key", i, F.get("sketch", i)))
            rows = deeper.select("doc", "a", "n", F.explode_outer(nxt).alias("key")).where("key is not null")
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out, tables


def _groups(batches):
    """Whole groups of key from batches that are sorted by key: frames in which no group is cut."""
    held = None
    for pdf in batches:
        pdf = pdf if held is None else pd.concat((held, pdf), ignore_index=True)
        last = pdf["key"].iloc[-1] if len(pdf) else None
        whole = pdf["key"].to_numpy() != last
        if whole.any():
            yield pdf[whole].reset_index(drop=True)
        held = pdf[~whole].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _blocks(side: np.ndarray):
    """(begin, end) of two blocks of a group's rows, for all pairs of blocks but those within one side. side: sorted; 0 counts as no side."""
    cuts = [(a, min(a + BLOCK, len(side))) for a in range(0, len(side), BLOCK)]
    for k, (a, b) in enumerate(cuts):
        for c, d in cuts[k:]:
            if not 0 < side[a] == side[d - 1]:
                yield (a, b), (c, d)


def _pairs(key: np.ndarray, side: np.ndarray):
    """Positions of all pairs within runs of equal keys, but for those within one side, some hundred thousand at once. Both sorted."""
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    end = np.append(new[1:], len(key))
    size = end - new
    many = np.where(size <= BLOCK, size * (size - 1) // 2, 0)
    load = np.cumsum(many) // 200_000
    for at in np.split(np.arange(len(new)), np.flatnonzero(np.diff(load)) + 1):
        at = at[size[at] <= BLOCK]
        row = spread(new[at], size[at])
        n = np.repeat(end[at], size[at]) - row - 1
        yield np.repeat(row, n), spread(row + 1, n)
    for a, b in zip(new[size > BLOCK], end[size > BLOCK], strict=True):
        for (p, q), (r, s) in _blocks(side[a:b]):
            i, j = np.indices((q - p, s - r)).reshape(2, -1)
            i, j = i + a + p, j + a + r
            yield i[i < j], j[i < j]


class Owner:
    """Tells of pairs of rows of a frame (node, side, nodes, doc) whether they belong to where they stand."""

    def __init__(self, g: pd.DataFrame):
        size = g["nodes"].str.len().to_numpy()
        self.nodes = np.full((len(g), int(size.max())), np.iinfo(np.int64).max)
        self.nodes[np.repeat(np.arange(len(g)), size), spread(np.zeros(len(g), np.int64), size)] = np.concatenate(g["nodes"].to_numpy())
        self.node, self.side, self.doc = (g[c].to_numpy() for c in ("node", "side", "doc"))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        ok = (self.doc[i] != self.doc[j]) & ((self.side[i] == 0) | (self.side[i] != self.side[j]))
        live = np.flatnonzero(ok)
        for k in range(self.nodes.shape[1]):  # near duplicates share nearly all nodes, so few pairs stay for long
            one = self.nodes[i[live], k]
            live, one = live[one < self.node[i[live]]], one[one < self.node[i[live]]]
            if not len(live):
                break
            met = (self.nodes[j[live]] == one[:, None]).any(axis=1)
            ok[live[met]] = False
            live = live[~met]
        return ok


def candidates(reps: DataFrame, keyed: DataFrame, exact: bool = False) -> DataFrame:
    """key, node, side, doc and a: in which buckets a document has a pair of its own that is small or whose sketches agree often enough. reps: doc, a, n, marks, nodes."""

    def rows(batches):
        for g in _groups(batches):
            n = g["n"].to_numpy()
            sk = np.frombuffer(b"".join(g["marks"]), np.uint8).reshape(len(g), BINS)
            owned, some = Owner(g), np.zeros(len(g), bool)
            for i, j in _pairs(g["key"].to_numpy(), g["side"].to_numpy()):
                ok = np.minimum(n[i], n[j]) >= SIMILARITY * np.maximum(n[i], n[j])
                i, j = i[ok], j[ok]
                ok = (np.minimum(n[i], n[j]) < FEW) | exact  # verified whatever their sketches
                large = np.flatnonzero(~ok)
                ok[large] = (sk[i[large]] == sk[j[large]]).sum(axis=1) >= AGREE
                i, j = i[ok], j[ok]
                ok = owned(i, j)
                some[i[ok]] = some[j[ok]] = True
            yield g.loc[some, ["key", "node", "side", "doc", "a"]]

    spark = reps.sparkSession
    rows_in = keyed.join(reps.select("doc", "a", "n", "marks", "nodes"), ["doc", "a"]).repartition(partitions(spark), "key").sortWithinPartitions("key", "side")
    return rows_in.select("key", "node", "side", "doc", "a", "n", "marks", "nodes").mapInPandas(rows, "key long, node long, side int, doc long, a long")


def _similar(sets: list[np.ndarray], side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions with a similarity of SIMILARITY or more, but for those within one side. side: sorted."""
    size = np.array([len(x) for x in sets])
    first = np.concatenate(([0], np.cumsum(size)))
    _, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

    def matrix(block: tuple[int, int], columns: np.ndarray) -> np.ndarray:
        ids, own = at[first[block[0]] : first[block[1]]], np.repeat(np.arange(block[1] - block[0]), size[block[0] : block[1]])
        k = np.minimum(np.searchsorted(columns, ids), len(columns) - 1)
        ok = columns[k] == ids
        m = np.zeros((block[1] - block[0], len(columns)), np.float32)
        m[own[ok], k[ok]] = 1
        return m

    for x, y in _blocks(side):
        ids = np.concatenate([np.unique(at[first[b[0]] : first[b[1]]]) for b in ((x, y) if x != y else (x,))])
        both = np.sort(ids)
        both = both[:-1][both[1:] == both[:-1]] if x != y else both[df[both] > 1]
        common = np.zeros((x[1] - x[0], y[1] - y[0]), np.float32)
        for k in range(0, len(both), 1 << 14):
            columns = both[k : k + (1 << 14)]
            m = matrix(x, columns)
            common += m @ (m if x == y else matrix(y, columns)).T
        i, j = np.indices(common.shape).reshape(2, -1)
        i, j, common = i + x[0], j + y[0], common.ravel()
        ok = (i < j) & (common >= SIMILARITY * (size[i] + size[j] - common) - 1e-6)
        found.append((i[ok], j[ok]))
    return tuple(np.concatenate(z) for z in zip(*found, strict=True))


def _least_connected(doc: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least document that each one is connected with through pairs (i, j)."""
    least = doc.copy()
    while True:
        was = least.copy()
        np.minimum.at(least, i, was[j])
        np.minimum.at(least, j, was[i])
        if (least == was).all():
            return least


def verify(docs: DataFrame, reps: DataFrame, members: DataFrame) -> DataFrame:
    """doc, a, links (of the pairs that belong to a bucket, copies counted) and least, a row for each bucket. docs: doc, text; reps: doc, a, nodes, copies; members: as candidates gives them."""
    spark = docs.sparkSession
    need = members.groupBy("doc", "a").agg(F.collect_list(F.struct("key", "node", "side")).alias("at")).join(reps.select("doc", "a", "nodes", "copies"), ["doc", "a"])

    def sets(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_parts(batch):
                own, sh = shingles(*utf8(part.column("text")))
                k = part.num_rows
                a = np.zeros(k, np.uint64)
                np.add.at(a, own, sh)
                out = part.drop_columns(["text"]).append_column("set", blobs(np.searchsorted(own, np.arange(k + 1)), sh))
                yield out.filter(pa.array(a.view(np.int64) == part.column("a").to_numpy()))  # else another text under the same id

    held = docs.join(need.hint("shuffle_hash"), "doc").select("doc", "a", "text", "at", "nodes", "copies").mapInArrow(sets, "doc long, a long, at array<struct<key:long,node:long,side:int>>, nodes array<long>, copies long, set binary")
    dealt = held.select(F.explode("at").alias("at"), "doc", "a", "nodes", "copies", "set").select("at.*", "doc", "a", "nodes", "copies", "set")
    dealt = dealt.repartition(partitions(spark), "key").sortWithinPartitions("key", "side")

    def rows(batches):
        for frame in _groups(batches):
            for _, g in frame.drop_duplicates(["key", "doc", "a"]).groupby("key", sort=False):
                if len(g) < 2:
                    continue
                i, j = _similar([np.frombuffer(x, np.uint64) for x in g["set"]], g["side"].to_numpy())
                ok = Owner(g)(i, j)
                i, j, doc, copies = i[ok], j[ok], g["doc"].to_numpy(), g["copies"].to_numpy()
                links = np.bincount(i, copies[j], len(g)) + np.bincount(j, copies[i], len(g))
                out = pd.DataFrame({"doc": doc, "a": g["a"].to_numpy(), "links": links.astype(np.int64), "least": _least_connected(doc, i, j)})
                yield out[out["links"] > 0]

    return dealt.select("key", "node", "side", "doc", "a", "nodes", "copies", "set").mapInPandas(rows, "doc long, a long, links long, least long")


# ---- groups --------------------------------------------------------------------------------


def components(links: DataFrame, name: str = "labels") -> DataFrame:
    """node and least node that it is connected with. links: x, y."""
    both = materialise(links.select("x", "y").union(links.select("y", "x")).distinct(), "edges")
    label = materialise(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")).withColumnRenamed("x", "node"), name)
    while True:
        near = both.join(label.withColumnRenamed("node", "y"), "y").groupBy("x").agg(F.min("label").alias("near")).withColumnRenamed("x", "node")
        least = label.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = label.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = materialise(least.join(jump, "label", "left").select("node", "old", F.least("label", "next").alias("label")), name)
        discard(label)
        label = moved
        if moved.where("old <> label").isEmpty():
            discard(both)
            return label


def near_duplicates(docs: DataFrame, recall: float = RECALL, exact: bool = False) -> DataFrame:
    """doc_id, class_id, copy_of, n_links of every row of docs. recall: for pairs at the bound of similarity. exact: no pair is left out for its sketches."""
    sig = materialise(signatures(docs), "signatures")
    classes = sig.where("doc_id is not null").groupBy("a", "b", "n").agg(F.min("doc_id").alias("copy_of"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(classes, "classes")
    marks = F.expr("array_join(transform(sketch, v -> lpad(hex(v & 255), 2, '0')), '')")
    chosen = sig.join(classes.select("a", "b", "n", "copies", F.col("copy_of").alias("doc_id")), ["doc_id", "a", "b", "n"]).dropDuplicates(["doc_id", "a", "b"])
    chosen = materialise(chosen.select(F.col("doc_id").alias("doc"), "a", "n", "copies", "sketch", F.unhex(marks).alias("marks")), "representatives")
    keyed, levels = buckets(chosen, recall)
    nodes = keyed.groupBy("doc", "a").agg(F.array_sort(F.collect_set("node")).alias("nodes"))
    reps = materialise(chosen.drop("sketch").join(nodes, ["doc", "a"]), "nodes")
    members = materialise(candidates(reps, keyed, exact), "members")
    for table in (chosen, *levels):
        discard(table)
    links = materialise(verify(docs.select(F.col("doc_id").alias("doc"), "text"), reps, members), "links")
    discard(reps)
    discard(members)
    label = components(links.where("doc <> least").select(F.col("doc").alias("x"), F.col("least").alias("y")))
    linked = links.groupBy("doc", "a").agg(F.sum("links").alias("linked")).withColumnRenamed("doc", "copy_of")
    known = classes.join(linked, ["copy_of", "a"], "left").join(label.select(F.col("node").alias("copy_of"), "label"), "copy_of", "left")
    known = known.select("a", "b", "n", "copy_of", F.coalesce("label", "copy_of").alias("class_id"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    # One row of known for each class, so the copies of a hot class don't meet in a task: AQE splits that side.
    out = sig.where("doc_id is not null").select("doc_id", "a", "b", "n").join(known, ["a", "b", "n"]).select("doc_id", "class_id", "copy_of", "n_links")
    out = materialise(out.unionByName(sig.where("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), F.lit(0).cast("long").alias("n_links"))), "near")
    for table in (sig, classes, links, label):
        discard(table)
    return out


def op6_jaccard_join(spark, sf_dir) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
