"""The training-data operators against plain versions, on small documents with all the odd cases."""

import random
import zlib

import brute
import pytest
import twins

SF = "/root/testdata/sf0.001"


def made(n: int = 60) -> list:
    r = random.Random(7)
    words = [f"w{k}" for k in range(300)]
    passage = " ".join(r.choices(words, k=70))
    out = []
    for i in range(n):
        body = r.choices(words, k=r.choice([3, 40, 120]))
        if i % 6 == 0:
            body[1:1] = passage.split()
        out.append((i, " ".join(body)))
    long = r.choices(words, k=200)
    near = list(long)
    near[100] = "changed"
    out += [(n, " ".join(long)), (n + 1, " ".join(near)), (n + 2, " ".join(long)), (n + 3, ""), (n + 4, None), (n + 5, " \n\t "), (n + 6, "é" * 120), (n + 7, "é" * 120), (n + 8, "one two")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), "doc_id long, text string")


def test_repeats_equal_a_dictionary_of_all_strings(spark, docs):
    from astroloom.llm import suffix_dedup

    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(docs, digest=True).collect()}
    assert got == brute.repeated(made())


def test_near_duplicates_equal_all_pairs(spark, docs):
    from astroloom.llm import jaccard_join

    rows = [r.asDict() for r in jaccard_join.near_duplicates(docs).collect()]
    want = brute.near(made())
    assert {r["doc_id"]: r["class_id"] for r in rows} == {i: c for i, (c, _) in want.items()}


def held(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_base_score_is_the_unigram_model(spark, docs):
    from pyspark.sql import functions as F

    from astroloom.llm import ctw
    from astroloom.llm.common import crc_mod

    got = {r.doc_id: r for r in ctw.score(docs.withColumn("held_out", crc_mod(F.col("doc_id"), 7) == 2)).collect()}
    for i, (n, known, total, base) in brute.unigram(made(), held).items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
        assert got[i].base_score == pytest.approx(base, abs=1e-6)
        assert got[i].score < 0


def test_packing_holds_every_token_once_without_gaps(spark, docs):
    from collections import defaultdict

    from astroloom.llm import packing

    rows = packing.pack_documents(docs).collect()
    seqs, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length))
    assert set(pieces) == {i for i, _ in made()}
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    for own in pieces.values():
        at = 0
        for k, (piece, start, length) in enumerate(sorted(own)):
            assert (piece, start) == (k, at)
            at += length


@pytest.mark.parametrize("name", ["op3_quality_rules", "op5_decontamination", "op10_license_scan"])
def test_sql_twins(spark, name):
    from astroloom.llm import registry

    assert twins.differ(registry.queries()[name](spark, SF), twins.connect(SF), registry.oracle_sql()[name]) == ""


def test_rules_of_urls(spark):
    from astroloom.llm import url_filter

    urls = [(1, "http://A.example.NET/en/x"), (2, "https://sub.b.net/q"), (3, "http://x.org/fr/a?b"), (4, "nothing"), (5, None), (6, "http://example.com/de/")]
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string")).collect()}
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/")
    assert got[2] == ("sub.b.net", "/q", "net/")
    assert got[3] == ("x.org", "/fr/a", "org/fr/")
    assert got[4] == got[5] == ("", "", None)
    assert got[6] == ("example.com", "/de/", "example.com/de/")


@pytest.mark.parametrize(("name", "target", "bar"), [("op9_quality_crf", "quality", 0.7), ("op8_toxicity", "toxic", 0.5)])
def test_held_out_accuracy(spark, name, target, bar):
    from astroloom.llm import registry

    out = registry.queries()[name](spark, "/root/testdata/sf0.01").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.join(labels, "doc_id").select("predicted", target).collect()
    assert len(rows) > 20
    right = sum(r[0] == r[1] for r in rows) / len(rows)
    print(name, len(rows), right)
    assert right >= 0.8


def test_empty_documents_table(spark, docs):
    from astroloom.llm import jaccard_join, packing, suffix_dedup

    none = docs.limit(0)
    assert packing.pack_documents(none).count() == 0
    assert suffix_dedup.dedup(none, digest=True).count() == 0
    assert jaccard_join.near_duplicates(none).count() == 0


def test_pieces_have_the_ids_of_the_tokenizer(spark, docs):
    """Every piece against `tokenizers` alone, a special token's string and odd texts included."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    from astroloom.llm import packing

    odd = [(901, "a <|endoftext|> b"), (902, None), (903, ""), (904, "a\x00b \U0001f600 é  \n\n\t x\r\n"), (905, "don't " * 3000), (None, "x"), (None, "x")]
    table = docs.select("doc_id", "text").limit(40).unionByName(spark.createDataFrame(odd, "doc_id long, text string")).cache()
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in table.collect():
        ids = own.encode(r.text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) % 1024 or 1024) if len(ids) > 1024 else len(ids)
        edges = [0, *range(first, len(ids) + 1, 1024)]
        want += [(r.doc_id, k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    got = packing.pack_documents(table).collect()
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    # No worse than first fit over falling lengths.
    free = []
    for n in sorted((w[3] for w in want), reverse=True):
        k = next((k for k, f in enumerate(free) if f >= n), None)
        if k is None:
            free.append(1024 - n)
        else:
            free[k] -= n
    assert len(by) <= len(free)
