import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airshed.llm import suffix

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, kept string"


def brute(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                hit[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if hit[i] and (i == 0 or not hit[i - 1]))
        kept = bytes(c for c, h in zip(t, hit) if not h)
        out.append((len(t), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])
    return df.select("doc_id", "n_bytes", n.alias("n"), F.size("spans"), F.sha2("kept", 256)).collect()


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = dict(zip((i for i, _ in docs), brute([t for _, t in docs], 400)))
    got = {r[0]: tuple(r[1:]) for r in suffix.op3_suffix_array_dedup(spark, DIR).collect()}
    assert got == want
    assert any(v[1] for v in want.values())


@pytest.mark.parametrize("length", [40, 41])
def test_overlaps_periods_and_splits(spark, length):
    import random

    rng = random.Random(5)
    block = "".join(rng.choice("abcdefgh é") for _ in range(500))
    texts = [block, "x" + block[100:260] + "y", block[:50] + block[30:90], "ab" * 200, "a" * 300, "a" * (length - 1), "a" * length, "", None, block[200:330] + "Z" + block[331:]]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA)
    want = brute([(t or "").encode() for t in texts], length)
    got = {r[0]: tuple(r[1:]) for r in rows(suffix.remove_repeats(docs, length))}
    assert [got[i] for i in range(len(texts))] == want


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = "the quick brown fox jumps over the lazy dog " * 3
    data = [(None, text + "a", "x"), (7, text + "b", "x"), (7, text + "b", "x"), (7, "other text", "y"), (8, "unique words only here", "x")]
    got = sorted((r[0] is None, r[0], r[1], r[2]) for r in rows(suffix.remove_repeats(spark.createDataFrame(data, SCHEMA), 100)))
    assert sorted(x[1] is None for x in got) == [False] * 4 + [True]
    by = {(g[1], g[2]): g[3] for g in got}
    assert by[(7, len(text) + 1)] == len(text) + 1 and by[(7, 10)] == 0 and by[(8, 22)] == 0
    assert by[(None, len(text) + 1)] == len(text)
    assert suffix.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text_in_parts(spark, monkeypatch):
    import random

    rng = random.Random(9)
    block = "".join(rng.choice("abcdefgh") for _ in range(3000))
    text = block + "".join(rng.choice("ijkl") for _ in range(4000)) + block[1000:2000]
    want = brute([text.encode(), b"q" + block[:700].encode()], 100)
    ranked, cut = suffix._sampled(100), None
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"id": [1], "text_hash": [2], "text": [text]})
    whole = {(lo, n) for b in ranked([batch]) for lo, n in zip(b.column("lo").to_pylist(), b.column("n").to_pylist())}
    monkeypatch.setattr(suffix.A, "PIECE", 1000)
    parts = [(lo, n) for b in suffix._sampled(100)([batch]) for lo, n in zip(b.column("lo").to_pylist(), b.column("n").to_pylist())]
    cover = [p for lo, n in parts for p in range(lo, lo + n)]
    assert sorted(cover) == list(range(len(text) - 99)) == sorted(p for lo, n in whole for p in range(lo, lo + n))
    assert want[0][1] > 1000


def test_written_tables_have_few_files(spark, monkeypatch, tmp_path):
    """What is little beside what was read for it needs no file for each partition of that."""
    import random

    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(4000)) for _ in range(60)]
    texts += [texts[0][:700] + "x" + texts[1][:700], texts[2]]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(8)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = dict(enumerate(brute([t.encode() for t in texts], 400)))
    files, write = {}, suffix.written

    def counted(df, name):
        out = write(df, name)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(suffix, "written", counted)
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        suffix.op3_suffix_array_dedup(spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    finally:
        for k in sizes:
            spark.conf.unset(k)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == want
    assert files["ranks"] <= 2 and files["twice"] <= 2 and len(out.inputFiles()) < 8, files
