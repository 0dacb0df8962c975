"""WARC archives: one gzip member per record, written and read by Spark tasks.

Writing: each task writes its records to files of its own in a folder that all machines
share; the rows it returns (path, bytes, records) are the manifest. Only files in the
manifest count, so what a lost or repeated task attempt leaves behind is never read.

Reading: files are cut into byte ranges without regard to records. A task scans its range
for the gzip magic, takes a candidate for a record only if it decodes to its end, begins with
a WARC header and is followed by another member or the end of the file, and then goes on
from member to member. It owns the records that start inside its range, and reads past the
range's end to finish the last one. A damaged member is skipped by scanning on; its bytes
are nobody's record. Memory: one record and a read buffer.

Payloads of at least 100 bytes that are equal are stored once: the page with the smallest
page_id is the response, the others are revisits that name it. Equal payloads are found by
an aggregate on their digest, which combines map-side; digests and page_ids are joined, not
payloads. A revisit holds no payload, so its record is made from that narrow table. The pages
themselves are asked map-side whether a Bloom filter of the revisits (8 MB whatever their
number) may hold them: what it does not hold is written where it is read, and what it holds
wrongly is known exactly from the narrow table and kept by a join with that list.

A null html is an empty payload; a null url has no target; a null page_id comes after all
others, so it revisits if its payload has another page; rows that repeat the smallest
page_id of a payload are all responses; control characters in a url are percent-encoded in
the header; an empty table writes and reads nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.session import scratch_path

from .tables import filter_words, read_table, tidy, with_possible, written

SHARE = 100  # bytes; smaller payloads are never shared
SPLIT = 8 << 20  # bytes of a range
FILE = 512 << 20  # bytes after which a task begins another file
MAGIC = b"\x1f\x8b\x08"
READ = 1 << 20
_MANIFEST = "path string, bytes long, records long"
_RECORDS = "record_type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, intact boolean, payload binary"


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def record(kind: str, name: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, size: int | None = None) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header only; its Content-Length
    there is still the payload's (`size`, if the payload is not at hand)."""
    size = len(payload) if size is None else size
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def _writer(folder: str, limit: int):
    def write(batches):
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, done = None, []
        for batch in batches:
            for name, url, html, digest, size, refers_to in zip(*(batch.column(c) for c in ("name", "url", "html", "digest", "size", "refers_to"))):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, length, records = fs.open_output_stream(path, compression=None), 0, 0
                kind = "revisit" if refers_to.is_valid else "response"
                data = record(kind, name.as_py() or "", url.as_py(), (html.as_py() or "").encode(), digest.as_py(), refers_to.as_py(), size.as_py())
                out.write(data)
                length, records = length + len(data), records + 1
                if length >= limit:
                    out.close()
                    done.append((path, length, records))
                    out = None
        if out is not None:
            out.close()
            done.append((path, length, records))
        if done:
            base = folder[: len(folder) - len(root)] if folder.endswith(root) else ""
            paths, sizes, counts = zip(*done)
            yield pa.RecordBatch.from_pydict({"path": [base + p for p in paths], "bytes": list(sizes), "records": list(counts)})

    return write


def write_archives(pages: DataFrame, folder: str, limit: int = FILE) -> DataFrame:
    """Write a record per page (page_id, url, html); returns the manifest."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html")})
    rows = rows.withColumn("pair", F.xxhash64("page_id", "digest"))
    with tidy() as made:
        narrow = written(rows.filter(F.col("size") >= SHARE).drop("html"), "payloads")
        shared = narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1 and first is not null")
        shared = written(shared.select("digest", "first"), "shared")
        again = written(narrow.join(shared, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first"))), "revisits")
        known = written(filter_words(again, "pair"), "filter")

        def same(a, b):
            return (a["digest"] == b["digest"]) & a["page_id"].eqNullSafe(b["page_id"])

        maybe = with_possible(narrow, known, "pair").filter("possible").drop("possible")
        wrongly = written(maybe.join(again, same(maybe, again), "left_anti").select("page_id", "digest").distinct(), "wrongly held")
        asked = with_possible(rows, known, "pair").withColumn("possible", F.col("possible") & (F.col("size") >= SHARE))
        held = asked.filter("possible")
        plain = asked.filter("not possible").unionByName(held.join(wrongly, same(held, wrongly), "left_semi"))
        name, none = F.col("page_id").cast("string").alias("name"), F.lit(None).cast("string")
        every = plain.select(name, "url", "html", "digest", "size", none.alias("refers_to"))
        every = every.union(again.select(name, "url", none.alias("html"), "digest", "size", F.col("first").cast("string").alias("refers_to")))
        manifest = written(every.mapInArrow(_writer(folder, limit), _MANIFEST), "manifest")
        made.remove(manifest)
    return manifest


class _Source:
    """Buffered reads of a file at any place."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.data)):
            self.at, self.data = at, self.file.read_at(max(0, min(max(n, READ), self.size - at)), at) if at < self.size else b""
        return self.data[at - self.at : at - self.at + n]


def _member(source: _Source, at: int) -> tuple[bytes, int] | None:
    """The WARC member that starts at `at` and the place after it, or None."""
    if source.get(at, 3) != MAGIC:
        return None
    z, out, place, checked = zlib.decompressobj(31), [], at, False
    try:
        while not z.eof:
            data = source.get(place, READ // 4)
            if not data:
                return None
            got = z.decompress(data)
            place += len(data) - len(z.unused_data)
            out.append(got)
            if not checked and sum(map(len, out)) >= 7:
                checked = True
                if not b"".join(out).startswith(b"WARC/1."):
                    return None
    except zlib.error:
        return None
    text = b"".join(out)
    return (text, place) if text.startswith(b"WARC/1.") else None


def members(source: _Source, start: int, end: int):
    """Contents of the members that start in [start, end)."""
    at, following = start, False
    while at < end:
        found = _member(source, at)
        if found and (following or found[1] == source.size or source.get(found[1], 3) == MAGIC):
            yield found[0]
            at, following = found[1], True
            continue
        following = False
        at += 1
        while at < end:  # on to the next magic
            data = source.get(at, min(READ // 4, end - at + 2))
            hit = data.find(MAGIC)
            if hit >= 0:
                at += hit
                break
            at += max(1, len(data) - 2)


def parse(content: bytes) -> dict:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next((int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha256:")
    revisit = fields["WARC-Type"] == "revisit"

    def bare(name):
        return fields[name][1:-1].removeprefix("urn:page:") if name in fields else None

    intact = revisit or (len(payload) == size and hashlib.sha256(payload).hexdigest() == digest)
    return {
        "record_type": fields["WARC-Type"], "record_id": bare("WARC-Record-ID"), "target_uri": fields.get("WARC-Target-URI"), "refers_to": bare("WARC-Refers-To"),
        "payload_bytes": size, "payload_digest": digest, "intact": intact, "payload": None if revisit else payload,
    }


def _reader(payloads: bool):
    schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()), ("payload", pa.binary())])

    def read(batches):
        for batch in batches:
            for path, size, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start", "end"))):
                fs, place = _filesystem(path)
                with fs.open_input_file(place) as file:
                    rows, held = [], 0
                    for content in members(_Source(file, size), start, end):
                        row = parse(content)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(content) if payloads else 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_archives(manifest: DataFrame, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """The records of the manifest's files (path, bytes)."""
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start")
    ranges = manifest.filter("bytes > 0").select("path", "bytes", start).withColumn("end", F.least(F.col("bytes"), F.col("start") + split))
    n = ranges.count()
    return ranges.repartition(max(1, min(n, 10_000))).mapInArrow(_reader(payloads), _RECORDS)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(read_table(spark, sf_dir, "pages"), scratch_path(spark, f"warc-{uuid.uuid4().hex}"))
    records = read_archives(manifest, payloads=False)
    page = F.when(F.col("record_id") != "", F.col("record_id").cast("long"))
    return records.select(page.alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
