"""Sorted arrays of op2: distinct values, training counts and look-ups against plain Python, and that np.unique's hashing isn't used on whole parts."""

from __future__ import annotations

import inspect
from collections import Counter

import numpy as np

from astroloom.llm import ctw


def test_counts_and_look_ups_equal_plain_ones():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5000):
        values, train = rng.integers(0, 900, n).astype(np.uint64) << np.uint64(50), rng.random(n) < 0.6
        every, count = ctw._counted(values, train)
        plain = Counter(values[train].tolist())
        assert every.tolist() == sorted(set(values.tolist())) and count.tolist() == [plain[v] for v in every.tolist()]
        held = np.arange(len(every), dtype=np.float32)
        query = values[rng.permutation(n)]
        assert ctw.look_up(every, held, query).tolist() == [every.tolist().index(v) for v in query.tolist()]


def test_parts_are_sorted_and_not_hashed():
    for step in (ctw._counted, ctw.gather, ctw.score, ctw.look_up):
        assert "np.unique" not in inspect.getsource(step)
