"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Node scores are linear in features of the line and of
its two neighbours, edges have a score for each pair of states. Training lines
take the label of their document; weights maximise the conditional likelihood
on a bounded sample. A document's quality is the mean of its lines' marginals of
good, from forward-backward, weighted by line length, calibrated by a logistic
curve on the same sample. Documents are scored in parallel, each as a whole.

Defined results: a null or empty text is one empty line; equal texts get equal
scores; an empty table gives no rows; with labels of one kind or none, every
score is the smoothed share of ones; further columns are ignored; texts of any
length are scored as a whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, crc_mod, discard, labelled_sample, materialise, read, text_parts

#: Labelled documents that the model is fitted on, their lines in all, and the lines of one of them, at most; longer ones are only scored.
SAMPLE_DOCS, SAMPLE_LINES, MOST_LINES = 3000, 300_000, 20_000
PREDICT_AT = 0.7
STEPS, RATE, L2 = 120, 0.15, 1e-3

_CLASSES = np.zeros(256, dtype=np.uint8)  # 1 blank, 2 upper case, 3 digit, 4 symbol, 5 exclamation, 6 bar, 7 full stop
for _k, _chars in enumerate((b" \t\r\x0b\x0c", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"!", b"|", b".?"), 1):
    _CLASSES[list(_chars)] = _k
_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (c[ends] - c[starts]).astype(float)


def line_features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, bytes of each line, number of lines of each text)."""
    raw = [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    n_lines = np.array([r.count(b"\n") + 1 for r in raw])
    doc = np.repeat(np.arange(len(raw)), n_lines)
    cls = _CLASSES[buf]
    size = (ends - starts).astype(float)
    some = np.maximum(size, 1)
    blank = (cls == 1) | (buf == 10)
    first = ~blank & np.concatenate(([True], blank[:-1]))
    n_words = _sums(first, starts, ends)
    # Hash of each word and line: a polynomial over 64-bit integers that wraps.
    powers = np.full(len(buf) + 1, _P, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inverse = np.full(len(buf) + 1, _PINV, dtype=np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    h = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers[:-1], dtype=np.uint64)))
    ws = np.flatnonzero(first)
    we = np.flatnonzero(~blank & np.concatenate((blank[1:], [True]))) + 1
    wh = (h[we] - h[ws]) * inverse[ws]
    again = np.zeros(len(buf), bool)
    if len(ws):
        own_doc = doc[np.searchsorted(ends, ws)]
        again[ws[1:]] = (wh[1:] == wh[:-1]) & (own_doc[1:] == own_doc[:-1])
    lh = (h[ends] - h[starts]) * inverse[starts]
    _, back, count = np.unique(np.stack((lh, doc.astype(np.uint64))), axis=1, return_inverse=True, return_counts=True)
    dup = (count[np.ravel(back)] > 1) & (size > 0)
    words = np.maximum(n_words, 1)
    own = np.stack(
        [
            _sums(cls == 4, starts, ends) / some,
            _sums(cls == 2, starts, ends) / some,
            _sums(cls == 3, starts, ends) / some,
            _sums(cls == 5, starts, ends) / some,
            _sums(cls == 6, starts, ends) / words,
            _sums(cls == 7, starts, ends) / words,
            _sums(again, starts, ends) / words,
            dup.astype(float),
            np.minimum(np.log1p(n_words), 6) / 3,
            np.minimum((size - n_words) / words, 30) / 10,
            (n_words == 0).astype(float),
        ],
        axis=1,
    )
    before, after = np.roll(own[:, :8], 1, axis=0), np.roll(own[:, :8], -1, axis=0)
    before[np.concatenate(([True], doc[1:] != doc[:-1]))] = 0
    after[np.concatenate((doc[1:] != doc[:-1], [True]))] = 0
    return np.hstack((np.ones((len(own), 1)), own, before, after)), size, n_lines


def _marginals(node: np.ndarray, edge: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of good for each line, and summed pair marginals. node: score of good; edge: 2 x 2 scores.

    Texts of similar length go together; a step moves all of them by a line."""
    good = np.zeros(len(node))
    pairs = np.zeros((2, 2))
    at = np.concatenate(([0], np.cumsum(n_lines)[:-1]))
    order = np.argsort(-n_lines, kind="stable")
    m = np.exp(edge - edge.max())
    score = np.clip(node, -30, 30)
    psi = np.stack((np.ones(len(node)), np.exp(score)), axis=1)
    psi /= psi.sum(axis=1, keepdims=True)
    cuts = [0]
    while cuts[-1] < len(order):  # a group spans lengths within a factor of two
        k = cuts[-1]
        cuts.append(k + max(1, int(np.searchsorted(-n_lines[order[k:]], -(n_lines[order[k]] // 2), "left"))))
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = order[a:b]
        n, s = n_lines[own], at[own]
        top = int(n[0])
        if top == 0:
            continue
        alpha = np.zeros((top, len(own), 2))
        alpha[0] = psi[s]
        for t in range(1, top):
            live = n > t
            x = alpha[t - 1, live] @ m * psi[s[live] + t]
            alpha[t, live] = x / x.sum(axis=1, keepdims=True)
        beta = np.ones((len(own), 2))
        for t in range(top - 1, -1, -1):
            live = n > t
            g = alpha[t, live] * beta[live]
            good[s[live] + t] = g[:, 1] / g.sum(axis=1)
            if t:
                nxt = psi[s[live] + t] * beta[live]
                joint = alpha[t - 1, live][:, :, None] * m[None] * nxt[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                x = nxt @ m.T
                beta[live] = x / x.sum(axis=1, keepdims=True)
    return good, pairs


def _quality(good: np.ndarray, size: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(n_lines)), n_lines)
    w = size + 1e-6
    return np.bincount(doc, good * w, len(n_lines)) / np.bincount(doc, w, len(n_lines))


def fit(x: np.ndarray, size: np.ndarray, n_lines: np.ndarray, y: np.ndarray) -> dict:
    """Weights by gradient steps on the mean conditional log-likelihood of the lines, then the calibration."""
    share = (y.sum() + 1) / (len(y) + 2)
    if len(y) == 0 or y.min() == y.max():
        return {"constant": float(share)}
    line_y = np.repeat(y, n_lines).astype(float)
    per_doc = np.repeat(1 / n_lines, n_lines)  # each document counts once
    weight = np.repeat(np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())), n_lines) * per_doc
    weight /= weight.sum()
    same = np.array([[np.sum((n_lines - 1)[y == 0]), 0], [0, np.sum((n_lines - 1)[y == 1])]], float)
    w, edge = np.zeros(x.shape[1]), np.zeros((2, 2))
    m1, m2 = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for step in range(1, STEPS + 1):
        good, pairs = _marginals(x @ w, edge, n_lines)
        grad = np.concatenate((x.T @ (weight * (line_y - good)) - L2 * w, ((same - pairs) / max(same.sum(), 1) - L2 * edge).ravel()))
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        move = RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-9)
        w, edge = w + move[: len(w)], np.clip(edge + move[len(w) :].reshape(2, 2), -2, 2)
    q = _logit(_quality(_marginals(x @ w, edge, n_lines)[0], size, n_lines))
    a, b = 1.0, 0.0
    for _ in range(30):  # Newton steps of the two-parameter calibration
        p = 1 / (1 + np.exp(-(a * q + b)))
        v, r = p * (1 - p) + 1e-9, y - p
        hess = np.array([[np.sum(v * q * q) + 1, np.sum(v * q)], [np.sum(v * q), np.sum(v) + 1e-3]])
        da, db = np.linalg.solve(hess, [np.sum(r * q) - a, np.sum(r)])
        a, b = a + da, b + db
    return {"w": w, "edge": edge, "a": float(max(a, 1e-3)), "b": float(b)}


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def score_texts(texts: list, model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    x, size, n_lines = line_features(texts)
    good, _ = _marginals(x @ model["w"], model["edge"], n_lines)
    return 1 / (1 + np.exp(-(model["a"] * _logit(_quality(good, size, n_lines)) + model["b"])))


def train(sample: DataFrame) -> dict:
    """sample: doc_id, text and y, as labelled_sample gives it. Features of SAMPLE_LINES lines at most come to the driver, those of whole documents in order of
    their ids' hashes; which ones is settled by ids and numbers of lines, so features are computed for these alone, where the texts are."""

    def rows(batches):
        for pdf in batches:
            for own in chunks(pdf):
                x, size, n = line_features(own["text"].tolist())
                cut = np.cumsum(n)[:-1]
                yield pd.DataFrame({"y": own["y"].to_numpy(), "n": n, "size": np.split(size, cut), "x": [v.ravel() for v in np.split(x, cut)]})

    held = materialise(sample.select("doc_id", "text", "y"), "labelled")
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(1))
    short = held.select("doc_id", lines.alias("n")).where(F.col("n") <= MOST_LINES).groupBy("doc_id").agg(F.sum("n").alias("n"))
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # two numbers for each of SAMPLE_DOCS ids at most
    chosen = short.withColumn("total", F.sum("n").over(before)).where(F.col("total") <= SAMPLE_LINES).select("doc_id")
    got = held.where(lines <= MOST_LINES).join(F.broadcast(chosen), "doc_id").mapInPandas(rows, "y int, n int, size array<double>, x array<double>").toPandas()
    discard(held)
    if got.empty:
        return {"constant": 0.5}
    x = np.concatenate(got["x"].tolist())
    n = got["n"].to_numpy()
    return fit(x.reshape(n.sum(), -1), np.concatenate(got["size"].tolist()), n, got["y"].to_numpy())


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score of every row of docs."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_parts(batch):
                yield pa.record_batch({"doc_id": part.column("doc_id").cast("int64"), "score": score_texts(part.column("text").to_pylist(), model)})

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, score double")


def keep(docs: DataFrame, model: dict, least: float) -> DataFrame:
    """The rows of docs, all columns unchanged, whose score is `least` or more."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for part in text_parts(batch):
                yield part.filter(pa.array(score_texts(part.column("text").to_pylist(), model) >= least))

    return docs.mapInArrow(rows, docs.schema)


def model_for(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_DOCS) -> dict:
    return train(labelled_sample(docs, labels, "quality", crc_mod(F.col("doc_id"), 4) != 2, rows))


def op9_quality_crf(spark, sf_dir) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality")
    out = score(docs, model_for(docs, labels))
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
