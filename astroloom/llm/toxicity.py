"""Toxicity from misspelled lexicon terms and their context.

The lexicon is learned from labelled training rows: words, and stems of words
that take many endings, which stand in toxic texts far more often than in
others; greedy by likelihood gained on texts that earlier terms don't explain.
The terms form a trie. The Levenshtein automaton of distance one, intersected
with that trie, is made deterministic once; a word is read letter by letter and
all words of a batch advance together, most of them leaving early.
A letter may be missing, added or replaced anywhere in terms of FUZZY letters or
more, and by a sign in terms of SIGNED letters or more. A sign at a word's edge
may as well be no part of it. Each hit then gets the evidence of its context: quotation marks or
words of report around it, or address ("you", exclamation). A logistic model of
the hits' sums gives the score.

Defined results: null and empty texts have no hit and get the score of a text
without hits; equal texts get equal scores; an empty table gives no rows; with
labels of one kind or none, every score is the smoothed share of ones; further
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, crc_mod, labelled_sample, read

#: Labelled documents that lexicon and weights are learned from, and candidates for the lexicon, at most.
SAMPLE_DOCS, CANDIDATES = 8000, 3000
#: A term must stand in so many toxic texts and be so many times as frequent there. Stems and terms open to misspelling have so many letters.
LEAST_DOCS, LEAST_RATIO, STEM, FUZZY, SIGNED = 4, 4.0, (4, 10), 5, 4
#: Letters before and after a hit that make its context.
CONTEXT = 40
INNER = "*#@$!%&-_0123456789"
QUOTES = "\"“”„«»‘’'"
REPORT = re.compile(r"\b(said|says|wrote|quote[ds]?|called|dijo|sagte|disait)\b|[\"“”„«»]", re.I)
ADDRESS = re.compile(r"\b(you|your|you're|tu|du|vous|usted)\b|!", re.I)


def tokens(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", text.lower())


# ---- lexicon -------------------------------------------------------------------------------


def learn_terms(sample: DataFrame) -> list[tuple[str, bool, float]]:
    """(term, whether it is a stem, log ratio). sample: doc_id, text, y."""

    def rows(batches):
        for pdf in batches:
            for doc_id, text, y in zip(pdf["doc_id"], pdf["text"], pdf["y"], strict=True):
                own = set(tokens(text)) if isinstance(text, str) else set()
                terms = {w for w in own if len(w) >= 3} | {w[:k] + "-" for w in own for k in range(STEM[0], min(STEM[1], len(w)) + 1)}
                if terms:
                    yield pd.DataFrame({"doc_id": np.full(len(terms), doc_id), "y": np.full(len(terms), y), "term": np.array(sorted(terms), dtype=object)})

    seen = sample.mapInPandas(rows, "doc_id long, y int, term string").persist()
    try:
        n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        t, c = n.get(1, 0), n.get(0, 0)
        if not t or not c:
            return []
        counts = seen.groupBy("term").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
        ratio = (F.col("a") / t) / ((F.col("b") + 0.5) / c)
        best = counts.where((F.col("a") >= LEAST_DOCS) & (ratio >= LEAST_RATIO)).orderBy(-F.col("a") * F.log(ratio), "term").limit(CANDIDATES)
        held = seen.join(F.broadcast(best.select("term")), "term").groupBy("term").agg(F.collect_list(F.when(F.col("y") == 1, F.col("doc_id"))).alias("toxic"), F.collect_list(F.when(F.col("y") == 0, F.col("doc_id"))).alias("clean")).collect()
    finally:
        seen.unpersist()
    sets = {r["term"]: (set(r["toxic"]), set(r["clean"])) for r in held}
    chosen, explained, blamed = [], set(), set()

    def gain(term: str) -> float:
        a, b = len(sets[term][0] - explained), len(sets[term][1] - blamed)
        return a * np.log(max((a / t) / ((b + 0.5) / c), 1e-9)) if a >= LEAST_DOCS else 0.0

    order = {term: gain(term) for term in sets}
    while order:
        term = max(order, key=lambda k: (order[k], k))
        now = gain(term)
        if now < order[term]:  # gains only fall, so a fresh one that is still the best is the best
            order[term] = now
            if now <= 0:
                del order[term]
            continue
        if now < 3.0 or len(sets[term][0] - explained) / t / ((len(sets[term][1] - blamed) + 0.5) / c) < LEAST_RATIO:
            del order[term]
            continue
        a, b = sets[term]
        chosen.append((term.rstrip("-"), term.endswith("-"), float(np.log((len(a) / t) / ((len(b) + 0.5) / c)))))
        explained |= a
        blamed |= b
        del order[term]
    return chosen


# ---- automaton -----------------------------------------------------------------------------


class Automaton:
    """Deterministic automaton of the terms within distance one. State 0 is dead, 1 the start."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        letters = sorted({ch for t, _, _ in terms for ch in t})
        self.code = {ch: k + 4 for k, ch in enumerate(letters)}  # 0: not in a word, 1: other letter, 2: sign between letters, 3: sign at a word's edge
        trie, ends = [{}], {}
        for k, (t, _, _) in enumerate(terms):
            at = 0
            for ch in t:
                if self.code[ch] not in trie[at]:
                    trie[at][self.code[ch]] = len(trie)
                    trie.append({})
                at = trie[at][self.code[ch]]
            ends.setdefault(at, []).append(k)
        # By the edit, 1: of letters, 2: of a sign in place of one, or added.
        fuzzy = [(True, len(t) >= FUZZY, len(t) >= SIGNED) for t, _, _ in terms]
        below = [[False] * len(trie) for _ in range(3)]  # does a term open to such an edit end at or under the node
        for e in (1, 2):
            for at in range(len(trie) - 1, -1, -1):
                below[e][at] = any(fuzzy[k][e] for k in ends.get(at, [])) or any(below[e][x] for x in trie[at].values())

        def closure(items: set) -> frozenset:
            todo, out = list(items), set(items)
            while todo:
                at, e = todo.pop()
                if at >= 0 and e == 0:  # a letter of the term is missing
                    for x in trie[at].values():
                        if below[1][x] and (x, 1) not in out:
                            out.add((x, 1))
                            todo.append((x, 1))
            return frozenset(i for i in out if not (i[1] and (i[0], 0) in out))

        def accepted(items: frozenset) -> tuple[int, int]:
            best = (-1, 0)
            for at, e in sorted(items, key=lambda i: i[1]):
                for k in [-at - 1] if at < 0 else ends.get(at, []):
                    if fuzzy[k][e] and (best[0] < 0 or (e == best[1] and terms[k][2] > terms[best[0]][2])):
                        best = (k, e)
            return best

        n = len(letters) + 4
        start = closure({(0, 0)})
        states, table, todo = {frozenset(): 0, start: 1}, [[0] * n, None], [start]
        while todo:
            items = todo.pop()
            row = [0] * n
            for ch in range(1, n):
                nxt = set()
                for at, e in items:
                    if ch == 3:
                        nxt.add((at, e))
                    if at < 0:  # a stem was read: any ending follows
                        nxt.add((at, e))
                        continue
                    for k in ends.get(at, []):
                        if terms[k][1] and fuzzy[k][e]:
                            nxt.add((-k - 1, e))
                    if ch in trie[at]:
                        nxt.add((trie[at][ch], e))
                    if e == 0:
                        edit = 2 if ch in (2, 3) else 1
                        for x in trie[at].values():
                            if below[edit][x]:
                                nxt.add((x, edit))
                        if below[edit][at]:
                            nxt.add((at, edit))
                new = closure(nxt)
                if new not in states:
                    states[new] = len(table)
                    table.append(None)
                    todo.append(new)
                row[ch] = states[new]
            table[states[items]] = row
        self.table = np.array(table, dtype=np.int32)
        self.term = np.full(len(table), -1, dtype=np.int32)
        self.errors = np.zeros(len(table), dtype=np.int8)
        for items, k in states.items():
            self.term[k], e = accepted(items)
            self.errors[k] = e > 0
        self.classes = np.zeros(0x10000, dtype=np.uint16)
        for cp in range(0x10000):
            if chr(cp).isalpha():
                self.classes[cp] = 1
        for ch, k in self.code.items():
            self.classes[ord(ch) & 0xFFFF] = k
        self.inner = np.zeros(0x10000, dtype=bool)
        self.inner[[ord(ch) for ch in INNER]] = True

    def hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(first letter, term, errors) of each word that is accepted, and the number of words. text: code points."""
        cp = np.where(text < 0x10000, text, 0xFFFF)
        cls = self.classes[cp]
        letter = cls > 0
        pad = np.concatenate(([False], letter, [False]))
        sign = self.inner[cp] & ~letter
        inner = sign & pad[:-2] & pad[2:]  # a sign between two letters stands for one
        cls[inner] = 2
        cls[sign & (pad[:-2] ^ pad[2:])] = 3  # one at a word's edge may
        word = letter | inner
        edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        marked = np.concatenate((cls == 3, [False]))
        start, end = start - marked[start - 1], end + marked[end]
        own, state, done = np.arange(len(start)), np.ones(len(start), np.int32), []
        step = 0
        while len(own):
            ended = start[own] + step >= end[own]
            if ended.any():
                final = state[ended]
                ok = self.term[final] >= 0
                done.append((own[ended][ok], final[ok]))
                own, state = own[~ended], state[~ended]
            state = self.table[state, cls[start[own] + step]]
            live = state > 0
            own, state = own[live], state[live]
            step += 1
        which, final = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(which, kind="stable")
        which, final = which[order], final[order]
        return start[which], self.term[final], self.errors[final], len(start)


# ---- scores --------------------------------------------------------------------------------


def text_features(texts: list, terms: list, automaton: Automaton) -> np.ndarray:
    """For each text: logs of the summed weight of plain, misspelled, quoted and addressed hits, kinds of term, and density."""
    plain = [t.lower() if isinstance(t, str) else "" for t in texts]
    lengths = np.array([len(t) + 1 for t in plain])
    joined = "\n".join(plain) + "\n"
    text = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at, term, errors, _ = automaton.hits(text)
    begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    doc = np.searchsorted(begins, at, "right") - 1
    out = np.zeros((len(texts), 6))
    kinds: dict[int, set] = {}
    for d, k, e, p in zip(doc.tolist(), term.tolist(), errors.tolist(), at.tolist(), strict=True):
        around = joined[max(begins[d], p - CONTEXT) : min(begins[d] + lengths[d], p + CONTEXT)]
        quoted = bool(REPORT.search(around))
        w = terms[k][2]
        out[d, 1 if e else 0] += w * (0.3 if quoted else 1.0)
        out[d, 2] += w * quoted
        out[d, 3] += w * (not quoted and bool(ADDRESS.search(around)))
        kinds.setdefault(d, set()).add(k)
    for d, own in kinds.items():
        out[d, 4] = sum(terms[k][2] for k in own)
        out[d, 5] = 100 * len(own) / max(20, lengths[d] / 6)
    return np.log1p(out)


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights, bias last, with a ridge."""
    x = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1.0] * (len(w) - 1) + [1e-3])
        w = w + np.linalg.solve(hess, x.T @ (y - p) - np.array([1.0] * (len(w) - 1) + [1e-3]) * w)
    return w


def _scored(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.hstack((x, np.ones((len(x), 1)))) @ w, -30, 30)))


def train(sample: DataFrame) -> dict:
    terms = learn_terms(sample)
    if not terms:
        got = sample.agg(F.sum("y").alias("a"), F.count("y").alias("n")).first()
        return {"constant": ((got["a"] or 0) + 1) / (got["n"] + 2)}
    automaton = Automaton(terms)

    def rows(batches):
        for pdf in batches:
            for own in chunks(pdf):
                yield pd.DataFrame({"y": own["y"].to_numpy(), "x": list(text_features(own["text"].tolist(), terms, automaton))})

    got = sample.mapInPandas(rows, "y int, x array<double>").toPandas()
    return {"terms": terms, "automaton": automaton, "w": fit(np.stack(got["x"].tolist()), got["y"].to_numpy())}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score and the number of distinct terms hit is left to text_features; a row for each of docs."""

    def rows(batches):
        for pdf in batches:
            for own in chunks(pdf):
                s = np.full(len(own), model["constant"]) if "constant" in model else _scored(text_features(own["text"].tolist(), model["terms"], model["automaton"]), model["w"])
                yield pd.DataFrame({"doc_id": own["doc_id"].astype("Int64"), "score": s})

    return docs.select("doc_id", "text").mapInPandas(rows, "doc_id long, score double")


def model_for(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_DOCS) -> dict:
    return train(labelled_sample(docs, labels, "toxic", crc_mod(F.col("doc_id"), 5) != 0, rows))


def op8_toxicity(spark, sf_dir) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "toxic")
    out = score(docs, model_for(docs, labels))
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
