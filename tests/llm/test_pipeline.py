"""The pipeline stage by stage against plain versions, each on what its predecessor kept."""

from __future__ import annotations

import hashlib
import zlib

import brute
import duckdb

SF = "/root/testdata/sf0.001"


def test_stages_equal_plain_versions(spark, tmp_path):
    import corpus_pipeline as P
    import public_tokenizers
    from tokenizers import Tokenizer

    from astroloom.llm import decontamination, quality_crf
    from astroloom.llm.common import read

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append([tuple(r) for r in docs.select("doc_id", "text").collect()] if k < 4 else docs.collect())
    every = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    # Quality: the classifier on one text at a time.
    model = quality_crf.model_for(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), read(spark, SF, "labels", "doc_id", "quality"))
    assert sorted(kept[0]) == sorted((i, t) for i, t in every if quality_crf.score_texts([t], model)[0] >= P.LEAST_QUALITY)
    # Near duplicates: all pairs that share a shingle.
    near = brute.near(kept[0])
    assert sorted(kept[1]) == sorted((i, t) for i, t in kept[0] if near[i][0] == i)
    # Repeats: every 50-byte string in a dictionary.
    want = brute.repeated(kept[1])
    before = dict(kept[1])
    assert sorted(i for i, _ in kept[2]) == sorted(before)
    for i, t in kept[2]:
        n, removed, _, digest = want[i]
        if not removed:
            assert t == before[i]
        elif hashlib.sha256(t.encode()).hexdigest() != digest:  # a cut has split a character
            assert len(t.encode()) < n - removed + 1
    # Leaks: the SQL twin.
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/2/*.parquet'; CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    leaked = {r[0] for r in con.sql(f"SELECT doc_id FROM ({decontamination.OP5_SQL}) WHERE contaminated").fetchall()}
    assert sorted(kept[3]) == sorted((i, t) for i, t in kept[2] if i not in leaked)
    # Packing: every token once, in sequences without gaps.
    own, texts, got = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), dict(kept[3]), {}
    for r in kept[4]:
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == set(texts)
    for i, parts in got.items():
        ids = own.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        parts.sort(key=lambda r: r.piece)
        assert sum(r.length for r in parts) == len(ids)
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[r.start : r.start + r.length]))
    assert sorted((tuple(r)[:5] for r in P.run(spark, SF).collect())) == sorted(tuple(r)[:5] for r in kept[4])
