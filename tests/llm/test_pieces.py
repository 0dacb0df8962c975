import sentencepiece

from airshed.llm import pieces

DIR = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "   a", "a  b", "a b ", "     " * 5 + "x", "\n\n\t\t  \n", "漢字かな交じり", "é é ﬁ 😀😀", "a\u0000b", "<s> </s> <0x41>", "hello" * 50, "............" * 9, "The representations, addEventListener!", "​ x", "aaaaaaa bbbbb", "Ω≈ç√∫˜µ≤"]


def library(texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    return [sp.encode(t) for t in texts]


def lists(encoder, texts):
    ids, rows = encoder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])]


def test_equals_the_library_on_odd_texts():
    encoder = pieces.Encoder(pieces.Vocabulary.read(pieces.MODEL))
    for _ in range(2):  # learnt, then remembered
        assert lists(encoder, [*ODD, None]) == [*library(ODD), []]


def test_query_equals_the_library_and_comes_back(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in pieces.op2_sentencepiece_round_trip(spark, DIR).collect()}
    want = dict(zip(docs, library(docs.values())))
    assert {i: r.ids for i, r in got.items()} == want
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in got.values())


def test_small_cache_and_groups_change_nothing(spark, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").select("text").limit(20).collect()]
    monkeypatch.setattr(pieces, "CACHE", 10)
    monkeypatch.setattr(pieces, "CACHED", 4)
    encoder = pieces.Encoder(pieces.Vocabulary.read(pieces.MODEL))
    assert [lists(encoder, [t])[0] for t in texts] == library(texts)


def test_nulls_repeats_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 5, "q"), (None, "a b", 6, "q"), (1, "a b", 7, "r"), (2, "", 8, "s")], "doc_id long, text string, ids long, decoded string")
    rows = pieces.decode(pieces.encode(docs)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, pieces.both_ways(docs).collect()))
    sp = library(["a b"])[0]
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in rows if r.text) == [("1", sp, "a b"), ("None", sp, "a b")]
    assert [(r.ids, r.decoded) for r in rows if r.text is None] == [(None, None)]
    assert [(r.ids, r.decoded) for r in rows if r.text == ""] == [([], "")]
    assert pieces.round_trip(docs.limit(0)).count() == 0


def test_long_runs_merge_in_n_log_n():
    import time

    encoder = pieces.Encoder(pieces.Vocabulary.read(pieces.MODEL))
    for text in (" " * 200_000, " " * 199_999 + "x", "  " + "=" * 50_000, "a  b" * 20_000, "ab" * 30_000):
        began = time.time()
        ids, rows = encoder.encode([text])
        assert time.time() - began < 30
        assert ids.tolist() == library([text])[0]


def test_heap_and_plain_merges_agree():
    import random

    encoder = pieces.Encoder(pieces.Vocabulary.read(pieces.MODEL))
    rnd = random.Random(4)
    for _ in range(400):
        text = "".join(rnd.choice(" aetn=-.él1") for _ in range(rnd.randrange(1, 60)))
        assert encoder._many_merges(text) == encoder._few_merges(text)
