"""Removal of long repeated passages with a logarithmic family of sparse suffix arrays.

A byte goes if a 50-byte string over it also starts in a document with a
smaller id. Each 50-byte string has one anchor, the least hash among its 24-byte
strings, about one in fourteen bytes; equal strings have equal anchors, so
only strings whose anchor stands in two documents can repeat.

1. Documents are numbered into batches of some megabytes and written as a table
   bucketed by batch, so that no later step moves a text again.
2. A batch deals its anchors, 32 bits each, to partitions by hash; a partition
   tells each batch which of its anchors stand in two documents or more.
3. A run is the neighbouring strings with one such anchor, with the bytes under
   them. Batches exchange 96-bit digests of their runs: the
   same run in a document with a smaller id settles all its strings, so the bytes
   of a run travel from the document with the least id alone, and only if another
   run has the same anchor and the same 13 bytes before or after it, by 16-bit
   mark: a string holds one of the two. Nothing grows with the number of copies
   but one digest for each batch.
4. Those bytes go to the partition of their anchor; anchors that very many
   batches hold are dealt by string. In a partition each batch gets a suffix
   array, its strings in order of their 50 bytes; arrays of like size are
   merge-scanned, strings that meet take the smaller id, and the merged array
   is the next level, as in a binary counter. Bytes are compared, not hashes.
5. What is covered goes back to the batches, which cut it out.

Everything is compared over all documents; nothing is sampled or capped.

Defined results: a null text is empty; a text under 50 bytes keeps all; a text
longer than a batch is a batch of its own and is worked through window by window;
documents with equal ids don't remove from each other; a null id counts as
greater than any, and such rows don't remove from each other; an empty table
gives no rows; cut() keeps further columns whatever their names, dedup() ignores
them.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blobs, bucketed, discard, dump, load, materialise, mixed, powers, prefix_hash, read, span_hash, spread, to_batches, unblob, utf8

MATCH, GRAM = 50, 24
#: Bytes of text in a batch, and for each partition of anchors, about.
BATCH_BYTES, PART_BYTES = 16_000_000, 8_000_000
#: Places that are worked through at once, so that arrays stay small; under 2^20.
WINDOW = 1_000_000
#: An anchor that more batches hold is dealt by its runs and strings; up to here its entries in one partition take some hundred kilobytes.
HOT_BATCHES = 10_000
LAST = np.iinfo(np.int64).max
U = np.uint64
WORD = U((1 << 31) - 1)
BESIDE = (MATCH - GRAM) // 2
#: What is exchanged of a run: digest, anchor with a bit for hot ones, and marks of both sides.
DIGEST = np.dtype([("a", "<u8"), ("b", "<u4"), ("word", "<u4"), ("left", "<u2"), ("right", "<u2")])


# ---- batches, anchors and runs -------------------------------------------------------------


class Texts:
    """The texts of a batch: bytes, ends of documents, and their ids as keys of comparison."""

    def __init__(self, table):
        import pyarrow.compute as pc

        self.buf, self.lengths = utf8(table.column("text"))
        self.ends = np.cumsum(self.lengths)
        self.key = pc.fill_null(table.column("doc_id").cast("int64"), int(LAST)).to_numpy().astype(np.int64)

    def doc(self, start: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, start, "right")

    def runs(self):
        """(start, strings, hash of the anchor, marks of what stands before and after it) of all runs, window by window."""
        for a in range(0, max(len(self.buf) - MATCH + 1, 0), WINDOW):
            own = self.buf[a : a + WINDOW + MATCH - 1]
            n = len(own) - MATCH + 1
            cut = np.clip(self.ends, a, a + n)
            inside = a + np.arange(MATCH, MATCH + n) <= np.repeat(self.ends, np.diff(cut, prepend=a))
            start, many, mark, left, right = _runs(own, inside)
            yield a + start, many, mark, left, right


def _side(h: np.ndarray, start: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """16 bits of the BESIDE bytes from start, never 0; 0 where not ok."""
    start = np.where(ok, start, 0)
    x = mixed(span_hash(h, start, start + BESIDE)) % U(65535) + U(1)
    return np.where(ok, x, U(0)).astype(np.uint16)


def _runs(own: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    h = prefix_hash(own)
    x = h[GRAM:] - h[:-GRAM]
    x *= powers(len(h))[1][: len(x)]
    x = mixed(x)
    least = ((x >> U(20)) << U(20)) | np.arange(len(x), dtype=U)
    width, have = MATCH - GRAM + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    at = (least & U((1 << 20) - 1)).astype(np.int32)  # anchor of the string that starts here
    other = at[1:] != at[:-1]
    start = np.flatnonzero(inside & np.concatenate(([True], other | ~inside[:-1])))
    end = np.flatnonzero(inside & np.concatenate((other | ~inside[1:], [True])))
    anchor = at[start].astype(np.int64)
    # A string holds BESIDE bytes before its anchor or as many after it; a run tells of a side if one of its strings does.
    left, right = _side(h, anchor - BESIDE, anchor - start >= BESIDE), _side(h, anchor + GRAM, anchor - end < BESIDE)
    return start, end - start + 1, x[anchor], left, right


def _place(mark: np.ndarray, parts: int) -> np.ndarray:
    """Partition of an anchor and 31 further bits of its hash, as one sortable number."""
    return ((mark >> U(32)) % U(parts) << U(31)) | (mark & WORD)


def _new(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where something sorted changes."""
    n = len(sorted_keys[0])
    flag = np.zeros(n, bool)
    flag[:1] = True
    for k in sorted_keys:
        flag[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(flag)


def _dealt(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of something sorted, and their edges."""
    new = _new(part)
    return part[new], np.append(new, len(part))


def _rows(batch: int, part: np.ndarray, **columns):
    import pyarrow as pa

    return pa.table({"batch": pa.array(np.full(len(part), batch, np.int64)), "part": pa.array(part.astype(np.int32)), **columns})


def anchors(parts: int):
    """The grouped function that deals a batch's distinct anchors; the last bit tells whether two of its documents hold one."""

    def rows(table):
        texts = Texts(table)
        found = [(_place(mark, parts), texts.key[texts.doc(start)]) for start, _, mark, _, _ in texts.runs()]
        place, key = (np.concatenate([f[k] for f in found] or [np.zeros(0, d)]) for k, d in ((0, U), (1, np.int64)))
        order = np.lexsort((key, place))
        place, key = place[order], key[order]
        new = _new(place)
        several = np.zeros(0, bool) if not len(new) else np.minimum.reduceat(key, new) != np.maximum.reduceat(key, new)
        part, edges = _dealt(place[new] >> U(31))
        return _rows(table.column("batch")[0].as_py(), part, marks=blobs(edges, (((place[new] & WORD) << U(1)) | several.astype(U)).astype(np.uint32)))

    return rows


def meet(table):
    """For each batch of a partition, its anchors that stand in two documents or more; the last bit tells of hot ones."""
    word, many = unblob(table.column("marks"), np.uint32)
    mark, several = word >> np.uint32(1), word & np.uint32(1)
    order = np.argsort(mark, kind="stable")
    new = _new(mark[order])
    size = np.diff(np.append(new, len(mark)))
    met = (size > 1) | (np.maximum.reduceat(several[order], new) > 0)
    value = np.where(met, np.where(size > HOT_BATCHES, 2, 1), 0).astype(np.uint32)
    own = np.empty(len(mark), np.uint32)
    own[order] = np.repeat(value, size)
    ok = own > 0
    edges = np.concatenate(([0], np.cumsum(np.add.reduceat(ok, np.cumsum(many) - many))))
    out = table.select(["batch", "part"]).append_column("marks", blobs(edges, (mark[ok] << np.uint32(1)) | (own[ok] - np.uint32(1))))
    return out.filter(np.diff(edges) > 0)


def exchange(parts: int):
    """The cogrouped function that finds a batch's runs at met anchors: their digests for the partitions, and a state that stays with the batch."""

    def rows(table, met):
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        batch = met.column("batch")[0].as_py()
        texts = Texts(table)
        word, many = unblob(met.column("marks"), np.uint32)
        part = np.repeat(met.column("part").to_numpy().astype(U), many)
        known = (part << U(31)) | (word >> np.uint32(1))
        order = np.argsort(known)
        known, hot = known[order], (word & np.uint32(1)).astype(bool)[order]
        got = []
        view = memoryview(np.ascontiguousarray(texts.buf))
        for start, n, mark, left, right in texts.runs():
            place = _place(mark, parts)
            at = np.minimum(np.searchsorted(known, place), len(known) - 1)
            ok = known[at] == place
            start, n, place, at = start[ok], n[ok], place[ok], at[ok]
            digest = b"".join([xxh3_128_digest(view[s:e]) for s, e in zip(start.tolist(), (start + n + MATCH - 1).tolist(), strict=True)])
            full = np.frombuffer(digest, np.dtype([("a", "<u8"), ("b", "<u4"), ("c", "<u4")]))
            own = np.empty(len(start), DIGEST)
            own["a"], own["b"], own["left"], own["right"] = full["a"], full["b"], left[ok], right[ok]
            own["word"] = (place & WORD) | (hot[at].astype(U) << U(31))
            got.append((start, n.astype(np.uint8), (place >> U(31)).astype(np.uint32), own))
        start, n, home, digest = (np.concatenate(x) for x in zip(*got, strict=True))
        hot = digest["word"] >> np.uint32(31) > 0
        key, to = texts.key[texts.doc(start)], np.where(hot, digest["a"] % U(parts), home.astype(U))
        order = np.lexsort((key, digest["b"], digest["a"]))
        new = _new(digest["a"][order], digest["b"][order])
        lead = np.sort(order[new])  # of each kind of run the one in the document with the least id
        kind = np.empty(len(order), np.int32)
        kind[order] = np.repeat(np.searchsorted(lead, order[new]), np.diff(np.append(new, len(order))))
        to = to[lead].astype(np.min_scalar_type(parts))
        dealt = np.argsort(to, kind="stable")
        part, edges = _dealt(to[dealt])
        empty = np.zeros(2, np.int64)
        state = dump(np.diff(start, prepend=0).astype(np.uint32), n, np.diff(kind, prepend=0), np.diff(lead, prepend=0).astype(np.uint32), to, np.packbits(hot[lead]))
        held = _rows(batch, np.array([-1]), digests=blobs(empty, np.zeros(0, np.uint8)), keys=pa.array([b""], pa.binary()), state=pa.array([state], pa.binary()))
        key = key[lead[dealt]]
        keys = [dump(np.diff(key[a:b], prepend=0)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        dealt = _rows(batch, part, digests=blobs(edges, digest[lead[dealt]]), keys=pa.array(keys, pa.binary()), state=pa.nulls(len(part), pa.binary()))
        return pa.concat_tables([held, dealt])

    return rows


def _met(*keys: np.ndarray) -> np.ndarray:
    """Which rows agree with another one in all keys, the last key not being 0."""
    order = np.lexsort(keys)
    new = _new(*(k[order] for k in keys))
    size = np.diff(np.append(new, len(order)))
    out = np.empty(len(order), bool)
    out[order] = np.repeat(size > 1, size)
    return out & (keys[-1] > 0)


def first_of(table):
    """Two bits for each run that a batch tells a partition of: does the document with the least id that has it stand in the batch,
    and if so, can a string of it stand in another run, as both have an anchor and one side in common? Hot ones always can."""
    import pyarrow as pa

    digest, many = unblob(table.column("digests"), DIGEST)
    key = np.concatenate([np.cumsum(load(x)[0]) for x in table.column("keys").to_pylist()])
    order = np.lexsort((digest["b"], digest["a"]))
    new = _new(digest["a"][order], digest["b"][order])
    size = np.diff(np.append(new, len(order)))
    kind = digest[order[new]]
    near = (kind["word"] >> np.uint32(31) > 0) | _met(kind["word"], kind["left"]) | _met(kind["word"], kind["right"])
    first, needed = np.empty(len(key), bool), np.empty(len(key), bool)
    first[order] = key[order] == np.repeat(np.minimum.reduceat(key[order], new), size)
    needed[order] = np.repeat(near, size)
    edges = np.cumsum(many)[:-1]
    flags = [np.packbits(np.concatenate(x)).tobytes() for x in zip(np.split(first, edges), np.split(first & needed, edges), strict=True)]
    return table.select(["batch", "part"]).append_column("flags", pa.array(flags, pa.binary())).append_column("count", pa.array(many.astype(np.int32)))


class Sent:
    """The runs of a batch, which of them it has first, and the records that it sends for those: whole runs, or strings of hot ones."""

    def __init__(self, texts: Texts, side, parts: int):
        state = side.filter(np.equal(side.column("part").to_numpy(), -1)).column("state")[0].as_py()
        start, many, kind, lead, to, hot = load(state)
        self.start, self.kind, self.lead = (np.cumsum(x, dtype=np.int64) for x in (start, kind, lead))
        self.many, hot = many.astype(np.int64), np.unpackbits(hot, count=len(lead)).astype(bool)
        self.key = texts.key[texts.doc(self.start)]
        flags = side.filter(np.array([x is not None for x in side.column("flags").to_pylist()], bool)).sort_by("part")
        counts = flags.column("count").to_numpy()
        both = [np.unpackbits(np.frombuffer(f, np.uint8), count=2 * n).astype(bool).reshape(2, n) for f, n in zip(flags.column("flags").to_pylist(), counts, strict=True)]
        self.first, needed = np.empty((2, len(lead)), bool)
        dealt = np.argsort(to, kind="stable")
        self.first[dealt], needed[dealt] = np.concatenate(both, axis=1)
        own = np.flatnonzero(needed)
        cold, warm = own[~hot[own]], own[hot[own]]
        n = self.many[self.lead[warm]]
        one = spread(self.start[self.lead[warm]], n)
        self.of = np.concatenate((cold, np.repeat(warm, n)))  # the run
        self.shift = np.concatenate((np.zeros(len(cold), np.int64), spread(np.zeros(len(warm), np.int64), n)))
        self.at = np.concatenate((self.start[self.lead[cold]], one))
        self.strings = np.concatenate((self.many[self.lead[cold]], np.ones(len(one), np.int64)))
        part = np.concatenate((to[cold].astype(U), _string_hash(texts.buf, one) % U(parts)))
        self.order = np.argsort(part, kind="stable")
        self.part = part[self.order]


def _string_hash(buf: np.ndarray, start: np.ndarray) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    view = memoryview(np.ascontiguousarray(buf))
    return np.array([xxh3_64_intdigest(view[s : s + MATCH]) for s in start.tolist()], U)


def bytes_of(parts: int):
    """The cogrouped function that sends out the bytes of the runs that a batch has first."""

    def rows(table, side):
        import pyarrow as pa

        texts = Texts(table)
        sent = Sent(texts, side, parts)
        part, edges = _dealt(sent.part)
        if not len(part):
            return _no("raw")()
        at, strings = sent.at[sent.order], sent.strings[sent.order]
        size = strings + MATCH - 1
        key = sent.key[sent.lead[sent.of[sent.order]]]
        raw = [dump(np.diff(key[a:b], prepend=0), strings[a:b].astype(np.uint8), texts.buf[spread(at[a:b], size[a:b])]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return _rows(side.column("batch")[0].as_py(), part, raw=pa.array(raw, pa.binary()))

    return rows


# ---- the family of suffix arrays -----------------------------------------------------------


class Family:
    """Sorted arrays of 50-byte strings, each with the least key that holds it; the size of a level at least doubles from one to the next."""

    def __init__(self):
        self.levels: list[list] = []  # strings, least keys, [rank of each string of each batch in it]

    def add(self, strings: np.ndarray, keys: np.ndarray) -> None:
        """A new batch: its suffix array is level 0, and meets the levels of like size."""
        self.levels.append(self._sorted(strings, keys, [np.arange(len(strings))], None))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            self._merge()

    @staticmethod
    def _sorted(strings, keys, ranks, cut) -> list:
        order = np.argsort(strings, kind="stable")  # two sorted arrays are merged in one pass
        ordered = strings[order]
        new = _new(ordered)
        size = np.diff(np.append(new, len(order)))
        rank = np.empty(len(order), np.int32)
        rank[order] = np.repeat(np.arange(len(new), dtype=np.int32), size)
        if cut is None:
            ranks = [rank]
        else:
            ranks = [rank[r] for r in ranks[0]] + [rank[cut + r] for r in ranks[1]]
        return [ordered[new], np.minimum.reduceat(keys[order], new), ranks]

    def _merge(self) -> None:
        a, b = self.levels[-2:]
        del self.levels[-2:]
        self.levels.append(self._sorted(np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1])), (a[2], b[2]), len(a[0])))

    def least(self) -> list[np.ndarray]:
        """The least key of each string of each batch, after all levels have met."""
        while len(self.levels) > 1:
            self._merge()
        _, keys, ranks = self.levels[0]
        return [keys[r] for r in ranks]


def strings_of(raw: np.ndarray, many: np.ndarray) -> np.ndarray:
    """All 50-byte strings of runs whose bytes follow each other."""
    size = many + MATCH - 1
    at = spread(np.cumsum(size) - size, many)
    return np.lib.stride_tricks.sliding_window_view(raw, MATCH)[at].view(f"S{MATCH}").ravel()


def resolve(table):
    """For each run of a partition, a bit for each string: is it in a document with a smaller id?"""
    import pyarrow as pa

    table = table.sort_by("batch")
    family, own = Family(), []
    for keys, many, raw in map(load, table.column("raw").to_pylist()):
        many = many.astype(np.int64)
        own.append((np.repeat(np.cumsum(keys), many), many))
        family.add(strings_of(raw, many), own[-1][0])
    out = []
    for (key, many), least in zip(own, family.least(), strict=True):
        bit = (key > least).astype(np.uint32) << spread(np.zeros(len(many), np.int64), many).astype(np.uint32)
        out.append(np.add.reduceat(bit, np.cumsum(many) - many, dtype=np.uint32).tobytes())
    return table.select(["batch", "part"]).append_column("bits", pa.array(out, pa.binary()))


# ---- cutting -------------------------------------------------------------------------------


def spans(texts: Texts, side, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each maximal removed run."""
    sent = Sent(texts, side, parts)
    words = side.filter(np.array([x is not None for x in side.column("bits").to_pylist()], bool)).sort_by("part")
    word, _ = unblob(words.column("bits"), np.uint32)
    bits = np.zeros(len(sent.lead), np.uint32)
    np.bitwise_or.at(bits, sent.of[sent.order], word << sent.shift[sent.order].astype(np.uint32))
    earlier = ~sent.first[sent.kind] | (sent.key > sent.key[sent.lead[sent.kind]])
    bits = np.where(earlier, np.uint32(0xFFFFFFFF), bits[sent.kind])
    full = bits & ((np.uint64(1) << sent.many.astype(U)) - U(1)).astype(np.uint32)
    whole = full == ((np.uint64(1) << sent.many.astype(U)) - U(1))
    some = (full > 0) & ~whole
    n = sent.many[some]
    place = spread(np.zeros(len(n), np.int64), n)
    on = (np.repeat(full[some], n) >> place.astype(np.uint32)) & np.uint32(1) > 0
    one = (np.repeat(sent.start[some], n) + place)[on]
    start = np.concatenate((sent.start[whole], one))
    end = np.concatenate((sent.start[whole] + sent.many[whole] + MATCH - 1, one + MATCH))
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    if not len(start):
        return start, end, start
    doc = texts.doc(start)
    far = np.maximum.accumulate(end)
    new = np.flatnonzero(np.concatenate(([True], (start[1:] > far[:-1]) | (doc[1:] != doc[:-1]))))
    return start[new], far[np.append(new[1:], len(start)) - 1], doc[new]


def _removed(table, side, parts: int):
    """Texts, bytes removed and spans of each document, and {document: kept bytes} of those that lose some."""
    texts = Texts(table)
    n = len(texts.lengths)
    if not len(side):
        return texts, np.zeros(n, np.int64), np.zeros(n, np.int64), {}
    start, end, doc = spans(texts, side, parts)
    kept, (docs, edges) = {}, _dealt(doc)
    for d, a, b in zip(docs.tolist(), edges[:-1], edges[1:], strict=True):
        stop = int(texts.ends[d])
        at, to = [stop - int(texts.lengths[d]), *end[a:b].tolist()], [*start[a:b].tolist(), stop]
        kept[d] = b"".join(texts.buf[x:y].tobytes() for x, y in zip(at, to, strict=True))
    return texts, np.bincount(doc, end - start, n).astype(np.int64), np.bincount(doc, minlength=n), kept


def _run(docs: DataFrame, final, schema) -> DataFrame:
    """final(table of a batch, what is known of it, number of partitions) for each batch, as a table."""
    spark = docs.sparkSession
    table = bucketed(to_batches(docs, BATCH_BYTES), "batches", "batch")
    parts = int(table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]) // PART_BYTES + 1
    texts = table.drop("size")
    bare = texts.select("batch", "doc_id", "text")
    marks = bare.groupBy("batch").applyInArrow(anchors(parts), "batch long, part int, marks binary")
    met = marks.groupBy("part").applyInArrow(meet, "batch long, part int, marks binary")
    # A batch without met anchors has nothing to say, and no partition gets anything from it.
    met_only = lambda f, empty: lambda t, m: f(t, m) if len(m) and len(t) else empty()
    runs = materialise(bare.groupBy("batch").cogroup(met.groupBy("batch")).applyInArrow(met_only(exchange(parts), _no("digests", "keys", "state")), "batch long, part int, digests binary, keys binary, state binary"), "runs")
    dealt = runs.where("part >= 0").select("batch", "part", "digests", "keys")
    flags = dealt.groupBy("part").applyInArrow(first_of, "batch long, part int, flags binary, count int")
    empty = F.lit(None).cast("binary")
    side = runs.where("part < 0").select("batch", "part", "state", empty.alias("flags"), F.lit(0).alias("count"))
    side = materialise(side.unionByName(flags.select("batch", "part", empty.alias("state"), "flags", "count")), "firsts")
    discard(runs)
    sent = bare.groupBy("batch").cogroup(side.groupBy("batch")).applyInArrow(met_only(bytes_of(parts), _no("raw")), "batch long, part int, raw binary")
    bits = materialise(sent.groupBy("part").applyInArrow(resolve, "batch long, part int, bits binary"), "bits")
    known = side.withColumn("bits", empty).unionByName(bits.select("batch", "part", empty.alias("state"), empty.alias("flags"), F.lit(0).alias("count"), "bits"))
    out = materialise(texts.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(lambda t, s: final(t, s, parts), schema), "deduplicated")
    for x in (table, side, bits):
        discard(x)
    return out


def _no(*columns: str):
    """Makes an empty table of batch, part and binary columns."""

    def make():
        import pyarrow as pa

        return pa.table({"batch": pa.array([], pa.int64()), "part": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in columns}})

    return make


def dedup(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary), or with digest the SHA-256 of kept instead."""

    def final(table, side, parts):
        import pyarrow as pa

        texts, removed, n_spans, kept = _removed(table, side, parts)
        begin = texts.ends - texts.lengths
        held = (kept[d] if d in kept else texts.buf[a:b] for d, (a, b) in enumerate(zip(begin.tolist(), texts.ends.tolist(), strict=True)))
        last = {"kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in held], pa.string())} if digest else {"kept": pa.array([bytes(x) for x in held], pa.binary())}
        return pa.table({"doc_id": table.column("doc_id").cast("int64"), "n_bytes": texts.lengths, "n_removed": removed, "n_spans": n_spans.astype(np.int64), **last})

    last = "kept_sha256 string" if digest else "kept binary"
    return _run(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), final, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")


def cut(docs: DataFrame) -> DataFrame:
    """docs with repeated passages cut out of text; characters that a cut splits go too."""
    names = docs.columns
    plain = [c if c in ("doc_id", "text") else f"x{k}" for k, c in enumerate(names)]
    renamed = docs.toDF(*plain)

    def final(table, side, parts):
        import pyarrow as pa

        _, _, _, kept = _removed(table, side, parts)
        table = table.drop_columns(["batch"])
        if not kept:
            return table
        text = table.column("text").to_pylist()
        for d, raw in kept.items():
            text[d] = raw.decode("utf-8", "ignore")
        at = table.schema.get_field_index("text")
        return table.set_column(at, table.schema.field(at), pa.array(text, table.schema.field(at).type))

    out = _run(renamed, final, renamed.schema)
    return out.toDF(*names)


def op4_suffix_dedup(spark, sf_dir) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents", "doc_id", "text"), digest=True)
