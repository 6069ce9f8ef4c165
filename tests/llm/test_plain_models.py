"""The line classifier against all labellings of short texts, the automaton against each term and word by itself."""

from __future__ import annotations

import itertools
import math
import random
import re

import numpy as np

BLANK = " \t\r\x0b\x0c"


def plain_features(text: str | None) -> np.ndarray:
    """Features of each line, character by character."""
    lines, last, own = (text or "").split("\n"), None, []
    for line in lines:
        words = [w for w in re.split(f"[{BLANK}]", line) if w]
        again = 0
        for w in words:
            again += w == last
            last = w
        size, n = len(line.encode()), max(1, len(words))
        share = lambda chars, of: sum(line.count(c) for c in chars) / of
        one = max(1, size)
        own.append([share("#*$%&<>", one), share("ABCDEFGHIJKLMNOPQRSTUVWXYZ", one), share("0123456789", one), share("!", one), share("|", n), share(".?", n), again / n, float(size > 0 and lines.count(line) > 1), min(math.log1p(len(words)), 6) / 3, min((size - len(words)) / n, 30) / 10, float(not words)])
    none = [0.0] * 8
    return np.array([[1.0, *x, *(own[k - 1][:8] if k else none), *(own[k + 1][:8] if k + 1 < len(own) else none)] for k, x in enumerate(own)])


def plain_quality(text: str | None, model: dict) -> float:
    node = np.clip(plain_features(text) @ model["w"], -30, 30)
    good, total = np.zeros(len(node)), 0.0
    for y in itertools.product((0, 1), repeat=len(node)):
        weight = math.exp(sum(s for s, v in zip(node, y, strict=True) if v) + sum(model["edge"][a, b] for a, b in itertools.pairwise(y)))
        total += weight
        good += weight * np.array(y)
    size = np.array([len(x.encode()) for x in (text or "").split("\n")]) + 1e-6
    p = min(max(float((good / total * size).sum() / size.sum()), 1e-4), 1 - 1e-4)
    return 1 / (1 + math.exp(-(model["a"] * math.log(p / (1 - p)) + model["b"])))


def test_quality_equals_the_sum_over_all_labellings(spark):
    from astroloom.llm import quality_crf as Q

    r = random.Random(3)
    words = ["good", "Good", "BUY", "now!!", "a.b?", "1|2", "x#*", "é", "the", "the"]
    line = lambda: r.choice(["", " ", "\t", "same line here"] + [" ".join(r.choices(words, k=r.randint(1, 9))) for _ in range(8)])
    texts = [None, "", "\n", "the", "the the\nthe", "end the", "the end"] + ["\n".join(line() for _ in range(r.randint(1, 9))) for _ in range(60)]
    rng = np.random.default_rng(1)
    model = {"w": rng.normal(0, 1.2, 28), "edge": np.array([[0.9, -1.1], [-0.4, 1.3]]), "a": 1.4, "b": -0.3}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {x.doc_id: x.score for x in Q.score(docs, model).collect()}
    want = {k: plain_quality(t, model) for k, t in enumerate(texts)}
    assert got.keys() == want.keys()
    np.testing.assert_allclose([got[k] for k in want], list(want.values()), rtol=1e-7)
    assert max(want.values()) - min(want.values()) > 0.5
    kept = {x.doc_id for x in Q.keep(docs, model, 0.5).collect()}
    assert kept == {k for k, v in want.items() if v >= 0.5}


def test_fit_takes_whole_documents_up_to_its_lines(spark, monkeypatch):
    from astroloom.llm import quality_crf as Q

    rows = [(k, "\n".join(["words in a line"] * (k + 1)), k % 2) for k in range(12)] + [(3, "again with one id", 1)]
    seen = {}
    monkeypatch.setattr(Q, "SAMPLE_LINES", 40)
    monkeypatch.setattr(Q, "MOST_LINES", 10)
    monkeypatch.setattr(Q, "fit", lambda x, size, n, y: seen.update(n=sorted(n.tolist()), x=x.shape, size=len(size)) or {"constant": 0.5})
    Q.train(spark.createDataFrame(rows, "doc_id long, text string, y int"))
    assert sum(seen["n"]) <= 40 and max(seen["n"]) <= 10 and len(seen["n"]) > 3
    assert seen["x"] == (sum(seen["n"]), 28) and seen["size"] == sum(seen["n"])


def plain_match(term: str, stem: bool, word: list[tuple[str, str]], fuzzy: int, signed: int) -> set[int]:
    """Edits (0 none, 1 of a letter, 2 by a sign) by which a word of (character, kind) is the term."""
    todo, seen = [(0, 0, 0)], set()
    while todo:
        at = todo.pop()
        if at in seen:
            continue
        seen.add(at)
        i, j, e = at
        if e == 0 and i < len(term):
            todo.append((i + 1, j, 1))
        if j < len(word):
            ch, kind = word[j]
            if kind == "edge" or (i == len(term) and stem):
                todo.append((i, j + 1, e))
            if i < len(term) and kind == "letter" and ch == term[i]:
                todo.append((i + 1, j + 1, e))
            if e == 0:
                edit = 1 if kind == "letter" else 2
                todo += [(i, j + 1, edit)] + ([(i + 1, j + 1, edit)] if i < len(term) else [])
    ok = (True, len(term) >= fuzzy, len(term) >= signed)
    return {e for i, j, e in seen if i == len(term) and j == len(word) and ok[e]}


def test_hits_equal_each_term_tried_on_each_word():
    from astroloom.llm import toxicity as T

    r = random.Random(7)
    terms = [("abcd", False, 1.0), ("abcde", False, 1.5), ("bcdea", True, 2.0), ("cab", False, 2.5), ("abec", True, 3.0), ("deadbe", False, 3.5), ("dead", False, 4.0)]
    automaton = T.Automaton(terms)
    sign = re.escape(T.INNER)
    words = []
    for _ in range(3000):
        w = list(r.choice(terms)[0] + r.choice(["", "", "s", "eda"]))
        for _ in range(r.randint(0, 2)):
            k = r.randrange(len(w))
            kind = r.randint(0, 2)
            w[k : k + (kind > 0)] = [r.choice("abcdexyé*@1")] if kind < 2 else []
            w = w or ["a"]
        words.append(r.choice(["", "", "#", "1", "--"]) + "".join(w) + r.choice(["", "", "!", "#", "..", "-0"]))
    text = r.choice(["", " "]) + " ".join(words)
    at, term, errors, n = automaton.hits(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    got = list(zip(at.tolist(), term.tolist(), (errors > 0).tolist(), strict=True))
    want, total = [], 0
    for m in re.finditer(f"[{sign}]?[^\\W\\d_]+(?:[{sign}][^\\W\\d_]+)*[{sign}]?", text):
        total += 1
        own = m.group()
        word = [(c, "letter" if c.isalpha() else "edge" if k in (0, len(own) - 1) else "inner") for k, c in enumerate(own)]
        found = [(e, -terms[k][2], k) for k, (t, stem, _) in enumerate(terms) for e in plain_match(t, stem, word, T.FUZZY, T.SIGNED)]
        if found:
            e, _, k = min(found)
            want.append((m.start(), k, e > 0))
    assert n == total and got == want
    assert 300 < sum(e for *_, e in want) and 300 < sum(not e for *_, e in want) and len(want) < total
