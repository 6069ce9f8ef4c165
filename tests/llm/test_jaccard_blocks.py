"""Pairs and similarities by blocks, against plain loops."""

from __future__ import annotations

import numpy as np
import pytest

from astroloom.llm import jaccard_join as J


@pytest.mark.parametrize("seed", range(5))
def test_pairs_of_groups(monkeypatch, seed):
    monkeypatch.setattr(J, "BLOCK", 4)
    r = np.random.default_rng(seed)
    key = np.sort(r.integers(0, 9, 60))
    side = np.where(key % 2 == 0, 0, r.integers(1, 3, 60))
    order = np.lexsort((side, key))
    key, side = key[order], side[order]
    got = [p for i, j in J._pairs(key, side) for p in zip(i.tolist(), j.tolist(), strict=True)]
    need = {(i, j) for i in range(60) for j in range(i + 1, 60) if key[i] == key[j] and (side[i] == 0 or side[i] != side[j])}
    every = {(i, j) for i in range(60) for j in range(i + 1, 60) if key[i] == key[j]}
    assert len(got) == len(set(got)) and need <= set(got) <= every


@pytest.mark.parametrize("seed", range(5))
def test_similar_by_blocks(monkeypatch, seed):
    monkeypatch.setattr(J, "BLOCK", 3)
    r = np.random.default_rng(seed)
    base = r.integers(0, 1 << 60, 40).astype(np.uint64)
    sets = [np.unique(np.concatenate((r.choice(base, 36, replace=False), r.integers(0, 1 << 60, r.integers(0, 6)).astype(np.uint64)))) for _ in range(20)]
    side = np.zeros(20, int) if seed % 2 else np.sort(r.integers(1, 3, 20))
    got = set(zip(*(x.tolist() for x in J._similar(sets, side)), strict=True))
    similar = lambda a, b: len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
    want = {(i, j) for i in range(20) for j in range(i + 1, 20) if similar(sets[i], sets[j])}
    need = {(i, j) for i, j in want if side[i] == 0 or side[i] != side[j]}
    assert want and need <= got <= want
