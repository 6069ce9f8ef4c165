"""The steps of the repeat removal, run one after the other without Spark, with small windows, batches and bounds."""

from __future__ import annotations

import random

import brute
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from astroloom.llm import suffix_dedup as S


def grouped(table: pa.Table, column: str):
    for value in pc.unique(table.column(column)).to_pylist():
        yield value, table.filter(pc.equal(table.column(column), value))


def chain(docs, batches: int, parts: int) -> dict:
    """doc number -> kept bytes, by the functions that Spark applies to groups."""
    texts = pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string()), "batch": pa.array([k % batches for k in range(len(docs))], pa.int64())})
    of = dict(grouped(texts, "batch"))
    marks = pa.concat_tables([S.anchors(parts)(t) for t in of.values()])
    met = pa.concat_tables([S.meet(t) for _, t in grouped(marks, "part")])
    if not len(met):
        return {}
    runs = pa.concat_tables([S.exchange(parts)(of[b], t) for b, t in grouped(met, "batch")])
    flags = pa.concat_tables([S.first_of(t) for _, t in grouped(runs.filter(pc.greater_equal(runs.column("part"), 0)), "part")])
    held = runs.filter(pc.less(runs.column("part"), 0))
    none = lambda n: pa.nulls(n, pa.binary())
    side = pa.concat_tables([
        pa.table({"batch": held["batch"], "part": held["part"], "state": held["state"], "flags": none(len(held)), "count": pa.array([0] * len(held), pa.int32())}),
        pa.table({"batch": flags["batch"], "part": flags["part"], "state": none(len(flags)), "flags": flags["flags"], "count": flags["count"]}),
    ])
    sent = pa.concat_tables([S.bytes_of(parts)(of[b], t) for b, t in grouped(side, "batch")])
    bits = [S.resolve(t) for _, t in grouped(sent, "part")]
    side = side.append_column("bits", none(len(side)))
    for t in bits:
        side = pa.concat_tables([side, pa.table({"batch": t["batch"], "part": t["part"], "state": none(len(t)), "flags": none(len(t)), "count": pa.array([0] * len(t), pa.int32()), "bits": t["bits"]})])
    out = {}
    for b, t in of.items():
        own, removed, spans, kept = S._removed(t, side.filter(pc.equal(side.column("batch"), b)), parts)
        for k in range(len(t)):
            begin = int(own.ends[k] - own.lengths[k])
            out[b + k * batches] = (int(own.lengths[k]), int(removed[k]), int(spans[k]), kept.get(k, own.buf[begin : int(own.ends[k])].tobytes()))
    return out


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("hot", [0, 1, 1000])
def test_chain_equals_dictionary(monkeypatch, seed, hot):
    import hashlib

    monkeypatch.setattr(S, "WINDOW", [70, 333, 1_000_000][seed % 3])
    monkeypatch.setattr(S, "HOT_BATCHES", hot)
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé \n") for _ in range(r.randint(1, 9)))
    passages = ["".join(word() for _ in range(r.randint(8, 40))) for _ in range(4)] + ["ab" * 60, " " * 200]
    docs = []
    for i in r.sample(range(100), 30):
        text = "".join(r.choice(passages)[r.randint(0, 30) :] if r.random() < 0.4 else word() for _ in range(r.randint(0, 12)))
        docs.append((i, r.choice([text, text, text, None, docs[-1][1] if docs else text])))
    got = chain(docs, batches=r.randint(1, 5), parts=r.randint(1, 4))
    want = brute.repeated(docs)
    assert got
    for k, (i, _) in enumerate(docs):
        n, removed, spans, kept = got[k]
        assert (n, removed, spans, hashlib.sha256(kept).hexdigest()) == want[i]
