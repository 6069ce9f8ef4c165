"""Language-model scores by context-tree weighting over bytes.

A text is its bytes in lower case (A-Z only) and an end mark. Each byte is
eight binary decisions; each decision has a context tree over the preceding
bytes, DEPTH deep. Every node holds a Krichevsky-Trofimov estimate of its
training decisions; the weighted probability of a node is half its own and half
its children's product. To predict, the estimates on the path are mixed with the
posterior weights that these probabilities give. A node without training
decisions leaves its share to its parent's estimate. The code length of a text in
bits is -score / log10(2).

Nothing of the model passes through one task or the driver but the tables of
depth 0 and 1, at most 257 x 256 nodes whatever the corpus:

1. Documents are numbered into batches of some megabytes, a table bucketed by
   batch, so that no later step moves a text. Batches give their distinct byte
   strings (context and byte) and distinct words with training counts, dealt into
   blobs: strings by the last two bytes of their context, words by hash.
2. A partition merges the strings of all batches and computes the trees below
   its contexts; sums for depth 1 and 0 are added up.
3. A partition computes the log probability of each string, and each batch gets
   those of its own strings; likewise for the words' counts.
4. A batch adds up its documents.

Words are told apart by 64-bit hash.

Defined results: a null or empty text is the end mark alone; rows with a null
doc_id are training rows; equal texts get equal scores; an empty table gives no
rows; without training rows the model gives each decision one half; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, crc_mod, discard, dump, load, materialise, mixed, partitions, prefix_hash, read, span_hash, to_batches, utf8

DEPTH = 5
END = 0xFF  # no UTF-8 text holds this byte
#: Bytes of text in a batch and in a part of it, about. Batches repeat the strings and words that they share, so few large ones move less; parts bound the arrays.
BATCH_BYTES, PART_BYTES = 24_000_000, 1_000_000
U = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


# ---- strings and words of a batch ----------------------------------------------------------


def codes(buf: np.ndarray, ends: np.ndarray, a: int, b: int, depth: int = DEPTH) -> np.ndarray:
    """For each byte of buf[a:b]: its context from the latest byte on, then the byte itself, as a number. buf: texts, each with its end mark; ends: where they end."""
    out = buf[a:b].astype(U)
    begin = np.concatenate(([0], ends[:-1]))
    begin = begin[(begin > a - depth) & (begin < b)]
    for d in range(1, depth + 1):
        before = np.full(b - a, END, U)
        low = max(a - d, 0)
        if b - d > low:
            before[low - (a - d) :] = buf[low : b - d]
        for k in range(d):  # contexts don't reach into the text before
            at = begin + k
            before[at[(at >= a) & (at < b)] - a] = END
        out |= before << U(8 * (depth + 1 - d))
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; np.unique hashes them, at seven times the cost of a sort."""
    values = np.sort(values)
    return values[_runs(values)]


def _counted(values: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and how often each stands in training rows."""
    every, own = distinct(values), np.sort(values[train])
    at = _runs(own)
    count = np.zeros(len(every), np.uint32)
    count[np.searchsorted(every, own[at])] = np.diff(at, append=len(own))
    return every, count


def _parts(buf: np.ndarray, ends: np.ndarray, limit: int | None = None):
    """Consecutive ranges (a, b) of a batch; one ends with a document or, in a longer one, after a blank, so no word is cut."""
    limit, a = limit or PART_BYTES, 0
    while a < len(buf):
        b = min(a + limit, len(buf))
        last = int(ends[max(int(np.searchsorted(ends, b, "right")) - 1, 0)])
        if a < last <= b:
            b = last
        else:
            stop = int(ends[np.searchsorted(ends, a, "right")])
            blank = np.flatnonzero(_SPACE[buf[a:b]])
            b = a + int(blank[-1]) + 1 if len(blank) else next((k + 1 for k in range(b, stop) if _SPACE[buf[k]]), stop)
        yield a, b
        a = b


def _share(ends: np.ndarray, a: int, b: int) -> np.ndarray:
    """How many bytes of each document lie in a range."""
    return np.diff(np.clip(ends, a, b), prepend=a)


def _united(got: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and summed counts of lists of both."""
    if len(got) == 1:
        return got[0]
    values = np.concatenate([v for v, _ in got])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], np.concatenate([c for _, c in got])[order]
    new = _runs(values)
    return values[new], np.add.reduceat(counts, new) if len(new) else counts


def _words(buf: np.ndarray, ends: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each word of buf[a:b]. The end mark counts as blank here; ends are counted by themselves."""
    blank = _SPACE[buf[a:b]]
    blank[ends[(ends > a) & (ends <= b)] - 1 - a] = True
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    h = prefix_hash(buf[a:b])
    return mixed(span_hash(h, start, end) ^ ((end - start).astype(U) << U(32))), np.searchsorted(ends, a + start, "right")


def _dealt(part: np.ndarray, n: int):
    order = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[order], np.arange(n + 1))
    for p in np.flatnonzero(np.diff(edge)):
        yield int(p), order[edge[p] : edge[p + 1]]


def part_of(code: np.ndarray, n: int, depth: int = DEPTH) -> np.ndarray:
    return (mixed(code >> U(8 * (depth - 1))) % U(n)).astype(np.int64)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _texts(table) -> tuple[np.ndarray, np.ndarray]:
    """The lower-case bytes of a batch, each text with its end mark, and their lengths."""
    raw, lengths = utf8(table.column("text"))
    lengths = lengths + 1
    buf = np.full(len(raw) + len(lengths), END, np.uint8)
    inner = np.ones(len(buf), bool)
    inner[np.cumsum(lengths) - 1] = False
    buf[inner] = _LOWER[raw]
    return buf, lengths


def gather(n: int, depth: int = DEPTH):
    """The grouped function that gives rows (batch, part, blob, kind): s the strings and w the words of a batch for a partition."""

    def rows(table):
        import pyarrow as pa

        buf, lengths = _texts(table)
        train = ~table.column("held_out").to_numpy().astype(bool)
        batch, out = table.column("batch")[0].as_py(), []
        ends = np.cumsum(lengths)
        every, count = _united([_counted(codes(buf, ends, a, b, depth), np.repeat(train, _share(ends, a, b))) for a, b in _parts(buf, ends)])
        out += [(p, dump(np.diff(every[at], prepend=U(0)), count[at]), "s") for p, at in _dealt(part_of(every, n, depth), n)]
        every, count = _united([_counted(word, train[doc]) for a, b in _parts(buf, ends) for word, doc in [_words(buf, ends, a, b)]])
        out += [(p, dump(every[at], count[at]), "w") for p, at in _dealt((every % U(n)).astype(np.int64), n)]
        part, blob, kind = zip(*out, strict=True)
        return pa.table({"batch": pa.array([batch] * len(out), pa.int64()), "part": pa.array(part, pa.int32()), "blob": pa.array(blob, pa.binary()), "kind": pa.array(kind, pa.string())})

    return rows


# ---- trees ---------------------------------------------------------------------------------


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5, by Stirling's series after a shift by eight."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - 1.1447298858494002 - lgamma(n0 + n1 + 1.0)


def _runs(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)


def _weighted(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    """log of half own and half below, both given as logs."""
    return np.logaddexp(own, below) - 0.6931471805599453


class Trees:
    """Nodes of depth `top` to `depth` for sorted distinct strings with counts; level k is the decision on bit 7 - k."""

    def __init__(self, string: np.ndarray, count: np.ndarray, depth: int = DEPTH, top: int = 2):
        self.string, self.depth, self.top = string, depth, top
        self.nodes: dict[tuple[int, int], tuple] = {}
        byte = string & U(255)
        count = count.astype(np.int64)
        for k in range(8):
            below = None
            one = (byte >> U(7 - k)) & U(1) > 0
            for d in range(depth, top - 1, -1):
                # (context of d bytes, leading bits of the byte): sort anew, as bits stand below the cut-off context bytes
                key = (string >> U(8 * (depth + 1 - d)) << U(8)) | (byte >> U(8 - k))
                every, inverse = np.unique(key, return_inverse=True)
                n1 = np.bincount(inverse, np.where(one, count, 0), len(every))
                n0 = np.bincount(inverse, np.where(one, 0, count), len(every))
                own = log_kt(n0, n1)
                if below is None:
                    log_w = own
                else:
                    child_key, child_w = below
                    parent = ((child_key >> U(16)) << U(8)) | (child_key & U(255))
                    log_w = _weighted(own, np.bincount(np.searchsorted(every, parent), child_w, len(every)))
                stop = np.exp(np.minimum(own - log_w - 0.6931471805599453, 0)) if d < depth else np.ones(len(every))
                self.nodes[d, k] = (every, inverse, n0, n1, stop)
                below = (every, log_w)
                if d == top:
                    self.nodes["w", k] = (every, log_w)

    def sums(self) -> pd.DataFrame:
        """n0, n1 and summed log weights for the nodes above the top."""
        out = []
        for k in range(8):
            every, log_w = self.nodes["w", k]
            _, _, n0, n1, _ = self.nodes[self.top, k]
            upper = (every >> U(16)).astype(np.int64)  # context of one byte, since top is two
            out.append(pd.DataFrame({"node": (upper << 8) | (1 << k) | (every & U(255)).astype(np.int64), "n0": n0, "n1": n1, "w": log_w}))
        return pd.concat(out).groupby("node", as_index=False).sum()

    def log10(self, upper: dict) -> np.ndarray:
        """log10 probability of the byte of each string given its context."""
        byte = (self.string & U(255)).astype(np.int64)
        latest = (self.string >> U(8 * self.depth)).astype(np.int64)
        total = np.zeros(len(byte))
        for k in range(8):
            one = (byte >> (7 - k)) & 1
            node = (1 << k) | (byte >> (8 - k))
            p = np.full(len(byte), 0.5)
            seen_below = np.zeros(len(byte), bool)
            for d in range(self.depth, -1, -1):
                if d >= self.top:
                    _, inverse, n0, n1, stop = self.nodes[d, k]
                    n0, n1, stop = n0[inverse], n1[inverse], stop[inverse]
                else:
                    n0, n1, stop = (upper[name][latest if d else 256, node] for name in ("n0", "n1", "stop"))
                own = (np.where(one > 0, n1, n0) + 0.5) / (n0 + n1 + 1)
                g = np.where(seen_below, stop, 1.0)
                p = np.where(n0 + n1 > 0, g * own + (1 - g) * p, p)
                seen_below |= n0 + n1 > 0
            total += np.log10(p)
        return total


def upper_tables(sums: pd.DataFrame) -> dict:
    """Dense tables of depth 1 (row: the context byte) and depth 0 (row 256)."""
    n0, n1, w = (np.zeros((257, 256)) for _ in range(3))
    at = sums["node"].to_numpy()
    for table, name in ((n0, "n0"), (n1, "n1"), (w, "w")):
        table[at >> 8, at & 255] = sums[name].to_numpy()
    own = log_kt(n0[:256], n1[:256])
    log_w = _weighted(own, w[:256])
    stop = np.ones((257, 256))
    stop[:256] = np.exp(np.minimum(own - log_w - 0.6931471805599453, 0))
    n0[256], n1[256] = n0[:256].sum(axis=0), n1[:256].sum(axis=0)
    own = log_kt(n0[256], n1[256])
    stop[256] = np.exp(np.minimum(own - _weighted(own, log_w.sum(axis=0)) - 0.6931471805599453, 0))
    return {"n0": n0, "n1": n1, "stop": stop}


def _strings(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    gap, count = load(blob)
    return np.cumsum(gap, dtype=U), count


def look_up(sorted_keys: np.ndarray, values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """values of keys that are all there. The queries are sorted, so that each distinct one is searched once and in order."""
    order = np.argsort(query)
    query = query[order]
    at = _runs(query)
    out = np.empty(len(query), values.dtype)
    out[order] = np.repeat(values[np.searchsorted(sorted_keys, query[at])], np.diff(at, append=len(query)))
    return out


def _gathered(blobs: list[tuple[int, bytes]], part: np.ndarray, dtype) -> np.ndarray:
    """What the partitions say about a batch's own distinct keys, in the order of those keys. part: the partition of each."""
    out = np.zeros(len(part), dtype)
    order = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[order], np.arange(int(part.max()) + 2 if len(part) else 1))
    for p, b in blobs:
        out[order[edge[p] : edge[p + 1]]] = load(b)[0]
    return out


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """docs: doc_id, text, held_out. Result: the columns of op2 for each row."""
    spark = docs.sparkSession
    n = partitions(spark)
    texts = bucketed(to_batches(docs.select("doc_id", "text", "held_out"), BATCH_BYTES).drop("size"), "ctw", "batch")
    gathered = materialise(texts.select("batch", "text", "held_out").groupBy("batch").applyInArrow(gather(n, depth), "batch long, part int, blob binary, kind string"), "strings", "kind")
    of = lambda kind: gathered.where(F.col("kind") == kind).select("batch", "part", "blob")

    def sums(pdf):
        return Trees(*_united([_strings(b) for b in pdf["blob"]]), depth).sums()

    upper = of("s").groupBy("part").applyInPandas(sums, "node long, n0 double, n1 double, w double").groupBy("node").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "w"))).toPandas()  # at most 256 x 255 rows
    tables = upper_tables(upper)

    def string_values(pdf):
        got = [_strings(b) for b in pdf["blob"]]
        every, count = _united(got)
        value = Trees(every, count, depth).log10(tables).astype(np.float32)
        return pd.DataFrame({"batch": pdf["batch"], "part": pdf["part"], "blob": [dump(value[np.searchsorted(every, v)]) for v, _ in got], "kind": "s", "known": 0, "total": 0})

    def word_values(pdf):
        got = [load(b) for b in pdf["blob"]]
        every, count = _united(got)
        return pd.DataFrame({"batch": pdf["batch"], "part": pdf["part"], "blob": [dump(count[np.searchsorted(every, own)].astype(np.uint32)) for own, _ in got], "kind": "w", "known": [int((count > 0).sum())] + [0] * (len(pdf) - 1), "total": [int(count.sum())] + [0] * (len(pdf) - 1)})

    out_schema = "batch long, part int, blob binary, kind string, known long, total long"
    words = materialise(of("w").groupBy("part").applyInPandas(word_values, out_schema), "words")
    known, total = words.agg(F.coalesce(F.sum("known"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    ends_seen = texts.agg(F.count_if(~F.col("held_out"))).first()[0]
    train_tokens, vocabulary = total + ends_seen, known + (ends_seen > 0)
    values = of("s").groupBy("part").applyInPandas(string_values, out_schema).unionByName(words)

    def final(table, v):
        import pyarrow as pa

        buf, lengths = _texts(table)
        kind, part, blob = (v.column(c).to_pylist() for c in ("kind", "part", "blob"))
        ends = np.cumsum(lengths)
        strings = _united([(k, k) for k in (distinct(codes(buf, ends, a, b, depth)) for a, b in _parts(buf, ends))])[0]
        value = _gathered([(p, x) for k, p, x in zip(kind, part, blob, strict=True) if k == "s"], part_of(strings, n, depth), np.float32)
        words = _united([(k, k) for k in (distinct(_words(buf, ends, a, b)[0]) for a, b in _parts(buf, ends))])[0]
        count = _gathered([(p, x) for k, p, x in zip(kind, part, blob, strict=True) if k == "w"], (words % U(n)).astype(np.int64), np.uint32)
        lg = lambda c: np.log10((c + 1.0) / (train_tokens + vocabulary + 1.0))
        k = len(lengths)
        scores, base = np.zeros(k), np.full(k, lg(ends_seen))
        n_tokens, n_known = np.ones(k, np.int64), np.full(k, int(ends_seen > 0), np.int64)
        for a, b in _parts(buf, ends):
            share = _share(ends, a, b)
            some = np.flatnonzero(share)
            scores[some] += np.add.reduceat(look_up(strings, value, codes(buf, ends, a, b, depth)).astype(float), np.cumsum(share[some]) - share[some])
            word, doc = _words(buf, ends, a, b)
            c = look_up(words, count, word).astype(float)
            base += np.bincount(doc, lg(c), k)
            n_tokens += np.bincount(doc, minlength=k)
            n_known += np.bincount(doc, c > 0, k).astype(np.int64)
        return pa.table({"doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "n_tokens": n_tokens, "n_known": n_known, "base_score": base, "score": scores, "n_bytes": lengths})

    done = texts.groupBy("batch").cogroup(values.groupBy("batch")).applyInArrow(final, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    out = materialise(done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score", (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte")), "scores")
    for x in (texts, gathered, words):
        discard(x)
    return out


def op2_ctw(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return score(docs.withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), 7) == 2, F.lit(False))))
