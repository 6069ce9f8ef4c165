"""Plain versions of the audit, the mix and the resampling, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def audit(docs: list[tuple], least_docs: int = 3, top: int = 200) -> set:
    """Rows (lang, source, part, item, value, rank) of documents (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    found = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))) for lang, source, text in docs]
    seen = Counter((lang, t) for lang, _, terms in found for t in set(terms))
    kept = defaultdict(set)
    for (lang, t), n in seen.items():
        if n >= least_docs:
            kept[lang].add(t)
    counts, whole = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in found:
        own = [t for t in terms if t in kept[lang]]
        counts[lang, source].update(own)
        whole[lang].update(own)

    def shares(lang, own):
        total = sum(own.values()) + len(kept[lang])
        return {t: 1 + 10**9 * (own[t] + 1) // total for t in kept[lang]}

    p, q = {g: shares(g[0], own) for g, own in counts.items()}, {lang: shares(lang, own) for lang, own in whole.items()}
    f = lambda a, b: (a - b) ** 2 // b
    out = set()
    for lang, source in counts:
        pairs = [(-sum(f(p[lang, source][t], p[lang, other][t]) for t in kept[lang]), other.encode()) for x, other in counts if x == lang and other != source]
        own = [(-f(p[lang, source][t], q[lang][t]), t.encode()) for t in kept[lang] if counts[lang, source][t] and p[lang, source][t] > q[lang][t]]
        for part, rows in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
            out |= {(lang, source, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(rows)}
    return out


def level(sizes: dict, weights: dict, budget: float, repeats: int) -> dict:
    """Targets by resharing the excess again and again."""
    full, share = set(), {}
    while True:
        left = budget - sum(sizes[s] * repeats for s in full)
        open_ = [s for s in sizes if s not in full]
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        more = {s for s in open_ if share[s] >= sizes[s] * repeats}
        if not more:
            return {s: sizes[s] * repeats if s in full else share[s] for s in sizes}
        full |= more


def resampled(docs: list[tuple], target: list, longest: int = 1, buckets: int = 10_000, least: int = 20, percent: int = 10, seed: int = 2024) -> list[tuple]:
    """Rows (doc_id, n_features, weight, score, rank)."""

    def runs(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    own = [(i, *runs(t)) for i, t in docs]
    s, t = Counter(b for _, _, x in own for b in x), Counter(b for x in target for b in runs(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for i, n, x in own:
        gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets)))) for b in x]
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if gain else 0
        rows.append((i, n, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = fit[: len(fit) * percent // 100]
    at = {id(r): k + 1 for k, r in enumerate(drawn)}
    return sorted(((r[0], *r[2:], at.get(id(r))) for r in rows), key=repr)
