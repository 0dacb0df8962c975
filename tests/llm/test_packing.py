"""Packing by powers of two against the tokenizers library, id by id."""

import zlib

import numpy as np
import pytest

from airshed.llm import packing as P

SCHEMA = "doc_id long, text string, length string, tokens int"


@pytest.fixture(scope="module")
def library():
    import tokenizers

    return tokenizers.Tokenizer.from_file(P.tokenizer_path())


def check(spark, library, docs, limit=1024):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA).repartition(3)
    rows = P.pack(df, limit=limit).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    want = sorted((d is None, d or 0, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in docs)
    by_doc = {}
    for r in rows:
        assert r.offset == 0 and r.length == len(r.tokens) // 4 and r.length & (r.length - 1) == 0 and r.length <= limit
        by_doc.setdefault((r.doc_id is None, r.doc_id or 0, r.doc_tokens), []).append((r.sequence_id, r.start, np.frombuffer(r.tokens, "<u4").tolist()))
    found = []
    for (null, d, n), parts in by_doc.items():
        ids = []
        for _, start, own in sorted(parts):  # rows that repeat an id follow each other by sequence
            assert start == len(ids) % n
            ids += own
        found += [(null, d, ids[i : i + n]) for i in range(0, len(ids), n)]
    assert sorted(found) == want
    return rows


def test_ids_and_pieces(spark, library):
    texts = ["", None, "a", "Hello, wörld!  It's  \n\n 12 o'clock", "  ", "\t\t x", "naïve café " * 700, "x" * 5_000, " " * 3_000, "日本語 テキスト 😀👍🏽‍", "end<|endoftext|>of <|endoftext|>", "'s 't''s !'ll", "   a\u0085b"]
    check(spark, library, list(enumerate(texts)))
    check(spark, library, [(1, "one two three"), (1, "one two three"), (None, "one two"), (None, None), (2, "three")], limit=4)


def test_whole_documents_of_the_table(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(spark, library, docs)
    for r in P.op12_pack_powers_of_two(spark, "/root/testdata/sf0.001").filter("start = 0").limit(20).collect():
        ids = [*library.encode(dict(docs)[r.doc_id] or "", add_special_tokens=False).ids, 0]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[: r.length], "<u4").tobytes())


def test_decomposition():
    for limit in (1, 8, 1024):
        for n in range(1, 3000, 7):
            cut = P.decomposition(n, limit)
            assert sum(cut) == n and all(x & (x - 1) == 0 and x <= limit for x in cut) and cut == sorted(cut, reverse=True)
            assert all(a > b for a, b in zip(cut, cut[1:]) if a < limit)  # no two that could be one
    with pytest.raises(ValueError):
        P.pack(None, limit=1000)


def test_ids_where_tiktoken_gives_up_or_could_differ(library):
    import json

    definition = open(P.tokenizer_path(), encoding="utf-8").read()
    own = P.TokenIds(definition)
    assert own.by_rank is not None
    for text in (" " * 1_500_000 + "x", "a<|endoftext|>b", "^" * 100_000):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    made = json.loads(definition)
    made["model"]["merges"] = [["t", "h"], *made["model"]["merges"]]  # ids do not follow these merges
    other = P.TokenIds(json.dumps(made))
    assert other.by_rank is None and other.encode("the thing").tolist() == other.library.encode("the thing", add_special_tokens=False).ids


def test_buckets_hold_one_length_and_are_pruned(spark, tmp_path, library):
    df = spark.createDataFrame([(i, "word " * (i * 37 % 500), "x", 1) for i in range(40)], SCHEMA)
    packed = P.pack(df)
    back = P.write_buckets(packed, str(tmp_path / "buckets"))
    assert back.count() == packed.count() and back.filter("bucket != length").count() == 0
    own = back.filter("bucket = 8")
    assert "PartitionFilters: [isnotnull(bucket" in own._jdf.queryExecution().toString() and {r.length for r in own.collect()} == {8}
    assert P.batch_size(8, 4096) * 8 == P.batch_size(1024, 4096) * 1024 == 4096


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA)).collect() == []
