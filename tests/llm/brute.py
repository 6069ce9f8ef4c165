"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib


def repeated(docs: list[tuple[int, str | None]], match: int = 50) -> dict:
    """doc_id -> (n_bytes, n_removed, n_spans, sha256) by a dictionary of all strings."""
    first: dict[bytes, int] = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        for p in range(len(b) - match + 1):
            s = b[p : p + match]
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - match + 1):
            if first[b[p : p + match]] < i:
                gone[p : p + match] = b"\x01" * match
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingle_set(text: str | None, words: int = 5) -> frozenset:
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def near(docs: list[tuple[int, str | None]], similarity: float = 0.8) -> dict:
    """doc_id -> (least id of its group, number of links), by all pairs that share a shingle."""
    from collections import Counter, defaultdict

    sets = {i: shingle_set(t) for i, t in docs}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s or [()]:
            where[x].append(i)
    links, parent = Counter(), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        seen = Counter(j for x in s or [()] for j in where[x] if j < i)
        for j, c in seen.items():
            if not s and not sets[j] or s and c >= similarity * (len(s) + len(sets[j]) - c) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (root(i), links[i]) for i in sets}


def unigram(docs: list[tuple[int, str | None]], held_out) -> dict:
    """doc_id -> (n_tokens, n_known, train_tokens, base score)."""
    import math
    from collections import Counter

    toks = {i: (t or "").encode().lower().split() + [None] for i, t in docs}
    count = Counter(w for i, ws in toks.items() if not held_out(i) for w in ws)
    n, v = sum(count.values()), len(count)
    return {i: (len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in toks.items()}


def ctw(docs: list[tuple[int, str | None]], held_out, depth: int) -> dict:
    """doc_id -> log10 probability, node by node with dictionaries."""
    import math
    from collections import defaultdict

    texts = {i: (t or "").encode().lower() + b"\xff" for i, t in docs}
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def steps(b):
        for p, byte in enumerate(b):
            ctx = (b"\xff" * depth + b[:p])[-depth:]
            for k in range(8):
                yield ctx, (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1

    for i, b in texts.items():
        if not held_out(i):
            for ctx, node, bit in steps(b):
                for d in range(depth + 1):
                    key = (ctx[depth - d :], node)
                    counts[key][bit] += 1
                    if d:
                        children[ctx[depth - d + 1 :], node].add(key)
    kt, weighted = {}, {}
    for key in sorted(counts, key=lambda x: -len(x[0])):
        a, b = counts[key]
        kt[key] = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        below = [weighted[c] for c in children[key]] if len(key[0]) < depth else None
        weighted[key] = kt[key] if below is None else max(kt[key], sum(below)) + math.log1p(math.exp(-abs(kt[key] - sum(below)))) - math.log(2)
    out = {}
    for i, b in texts.items():
        total = 0.0
        for ctx, node, bit in steps(b):
            p, seen = 0.5, False
            for d in range(depth, -1, -1):
                key = (ctx[depth - d :], node)
                if key in counts:
                    own = (counts[key][bit] + 0.5) / (sum(counts[key]) + 1)
                    g = math.exp(kt[key] - weighted[key]) / 2 if seen and d < depth else 1.0
                    p, seen = g * own + (1 - g) * p, True
            total += math.log10(p)
        out[i] = total
    return out
