import hashlib
import random
import zlib

import pytest

from airshed.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first long"


def gz(data):
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def source(data):
    import pyarrow as pa

    return warc._Source(pa.BufferReader(data), len(data))


@pytest.mark.parametrize("step", [1, 7, 64, 1000, 10**6])
def test_ranges_of_any_size_own_each_record_once(step):
    rng = random.Random(step)
    payloads = [bytes(rng.choice(b"<>abc \xc3") for _ in range(rng.choice([0, 5, 300, 4000]))) for _ in range(30)]
    members = [warc.record("response", str(i), f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads)]
    data = b"".join(members)
    s = source(data)
    got = [warc.parse(c) for a in range(0, len(data), step) for c in warc.members(s, a, min(a + step, len(data)))]
    assert [(r["record_id"], r["payload"], r["intact"]) for r in got] == [(str(i), p, True) for i, p in enumerate(payloads)]


def test_a_member_inside_a_stored_payload_and_a_damaged_member():
    rng = random.Random(1)
    inner = warc.record("response", "inner", "http://in", b"q" * 50, "0", None)
    noise = bytes(rng.randrange(256) for _ in range(60_000))
    outer = warc.record("response", "outer", "http://out", noise + inner + noise, "0", None)
    last = warc.record("response", "last", "http://last", b"z", "0", None)
    broken = bytearray(warc.record("response", "broken", "http://b", noise, "0", None))
    broken[len(broken) // 2] ^= 255
    data = outer + bytes(broken) + last
    assert inner[12:40] in data  # deflate stored it as it is
    for step in (997, len(data)):
        s = source(data)
        got = [warc.parse(c)["record_id"] for a in range(0, len(data), step) for c in warc.members(s, a, min(a + step, len(data)))]
        assert got == ["outer", "last"]


def test_shared_payloads_nulls_and_repeats(spark, tmp_path):
    big = "<p>é</p>" * 40
    pages = [(5, "http://a/\n", big, "x", 1), (3, "http://b", big, "x", 1), (9, None, big, "x", 1), (None, "http://n", big, "x", 1), (1, "u", "small", "x", 1), (2, "u", "small", "x", 1), (4, "e", "", "x", 1), (6, "e", None, "x", 1), (7, "s", "one of a kind " * 20, "x", 1), (3, "http://b", big, "x", 1)]
    manifest = warc.write_archives(spark.createDataFrame(pages, SCHEMA).repartition(3), str(tmp_path / "w"), limit=900)
    rows = warc.read_archives(manifest, split=100).collect()
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows) == len(pages)
    got = sorted((r.record_id, r.record_type, r.refers_to or "", r.payload_bytes) for r in rows)
    n = len(big.encode())
    assert got == sorted([("5", "revisit", "3", n), ("3", "response", "", n), ("9", "revisit", "3", n), ("", "revisit", "3", n), ("1", "response", "", 5), ("2", "response", "", 5), ("4", "response", "", 0), ("6", "response", "", 0), ("7", "response", "", 280), ("3", "response", "", n)])
    assert all(r.intact and (r.payload is None) == (r.record_type == "revisit") for r in rows)
    assert {r.target_uri for r in rows if r.record_id == "5"} == {"http://a/%0A"} and [r.target_uri for r in rows if r.record_id == "9"] == [None]
    empty = warc.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))
    assert warc.read_archives(empty).count() == 0


def test_what_the_filter_holds_wrongly_is_kept(spark, tmp_path, monkeypatch):
    """A filter of one word lets nearly every page pass as a possible revisit."""
    from pyspark.sql import functions as F

    from airshed.llm import tables

    monkeypatch.setattr(tables, "_key_word", lambda k: F.lit(0).cast("long") + 0 * k)
    pages = [(i, f"http://h/{i}", f"payload {i % 70} " * 20, "x", 1) for i in range(100)] + [(None, "n", "payload 99 " * 20, "x", 1)]
    manifest = warc.write_archives(spark.createDataFrame(pages, SCHEMA), str(tmp_path / "w"))
    got = {(r.record_id, r.record_type, r.refers_to) for r in warc.read_archives(manifest).collect()}
    assert got == {(str(i), "revisit" if i >= 70 else "response", str(i - 70) if i >= 70 else None) for i in range(100)} | {("", "response", None)}
