"""Removal of long byte strings that occur more than once (suffix dedup by prefix doubling).

Prefix doubling ranks positions by ever longer prefixes: the rank of the 2h bytes at p is
the pair (rank of the h bytes at p, rank of the h bytes at p + h), and a position whose
rank is unique is done. Doubling from one byte would sort every position of the corpus
nine times, so two things differ here, neither of which changes the result. Ranks are
64-bit fingerprints of their prefix, which need no global sort to be named. And the first
round, at half the threshold, ranks only sampled positions (sampling.py): each window of
`length` bytes is represented by one of them, and a window that occurs twice has the same
representative at the same offset. Positions with a unique rank go. The last round pairs,
for every window that may still be unique or not, the rank at its start with the rank half
a threshold on, and groups the pairs (of the second, 32 bits: 96 in all name a window).

Runs whose whole surroundings occur twice need no last round: every window in them does.
One row of each such context goes on as the partner of others, so thousands of copies cost
one. Aggregates combine map-side; what they leave is written before it is joined, so that a
hot rank is split by Spark's skew rule. What is little beside what was read for it is dealt
into few files.

Bytes covered by any repeated window go; nothing crosses documents; a null text is empty.
Rows that repeat (same doc_id, same text) count as copies of each other. A text shorter
than the threshold is left alone, an empty table gives an empty result, and other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .sampling import runs
from .tables import drop, few_files, keyed, read_table, shown_id, tidy, written

LENGTH = 400
PIECE = 1 << 19  # bytes of text whose positions are ranked together
_RUNS = "rank long, context long, id long, text_hash long, lo long, n int"
_WINDOWS = "id long, text_hash long, place long, rank long, next_rank int, alone boolean"
_KEPT = "id long, n_bytes long, spans array<struct<lo:long,hi:long>>, kept binary"


def _chunks(offsets: np.ndarray, buf: np.ndarray, length: int):
    """(row shift, place shift, offsets, bytes): a long text in overlapping parts, so that
    memory is bounded by the piece size and every window is in exactly one part."""
    if len(offsets) > 2 or len(buf) <= 2 * PIECE:
        yield 0, offsets, buf
        return
    for lo in range(0, len(buf) - length + 1, PIECE):
        part = buf[lo : lo + PIECE + length - 1]
        yield lo, np.array([0, len(part)]), part


def _sampled(length: int):
    k = -(-length // 2)

    def ranked(batches):
        A.enter("suffix: sampled")
        for batch in batches:
            for first, offsets, buf in A.pieces(batch.column("text"), PIECE):
                for shift, off, part in _chunks(offsets, buf, length):
                    if len(part) < length:
                        continue
                    total = A.prefix(part)
                    ranks = A.spans_of(total, np.arange(len(part) - k + 1), np.arange(k, len(part) + 1))
                    r = runs(ranks, off, length, k)
                    row = np.searchsorted(off, r.first, side="right") - 1
                    context = A.spans_of(total, r.first, r.last + length)
                    context = A.mix(context + A.mix(((r.at - r.first) << 20 | (r.last - r.first)).astype(np.uint64)))
                    at = pa.array(row + first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            A.longs(r.seed), A.longs(context), batch.column("id").take(at), batch.column("text_hash").take(at),
                            pa.array(r.first - off[row] + shift), pa.array((r.last - r.first + 1).astype(np.int32)),
                        ],
                        ["rank", "context", "id", "text_hash", "lo", "n"],
                    )

    return ranked


def _doubled(length: int):
    k = -(-length // 2)

    def pairs(batches):
        A.enter("suffix: doubled")
        for batch in batches:
            ids, hashes, parts = batch.column("id"), batch.column("text_hash"), batch.column("parts")
            for first, offsets, buf in A.pieces(batch.column("text")):
                for row in range(len(offsets) - 1):
                    own = parts[first + row].as_py()
                    text = buf[offsets[row] : offsets[row + 1]]
                    out = []
                    for part in own:
                        lo, n = part["lo"], part["n"]
                        total = A.prefix(text[lo : lo + n + length - 1])
                        p = np.arange(n)
                        out.append((lo + p, A.spans_of(total, p, p + k), A.spans_of(total, p + length - k, p + length), np.full(n, part["alone"])))
                    place, rank, next_rank, alone = (np.concatenate(x) for x in zip(*out))
                    same = pa.array(np.full(len(place), first + row))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(same), hashes.take(same), pa.array(place), A.longs(rank), pa.array((next_rank >> A.U(32)).astype(np.uint32).view(np.int32)), pa.array(alone)],
                        ["id", "text_hash", "place", "rank", "next_rank", "alone"],
                    )

    return pairs


def _cut(batches):
    A.enter("suffix: cut")
    for batch in (whole.slice(first, 500) for whole in batches for first in range(0, len(whole), 500)):
        ids, hashes, found = batch.column("id"), batch.column("text_hash"), batch.column("found")
        texts = batch.column("text").cast(pa.binary())
        n_bytes, spans, kept = [], [], []
        for i, text in enumerate(texts):
            text = text.as_py() or b""
            lo, hi = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if found[i].is_valid:
                v = found[i].values
                lo, hi = A.merge_spans(v.field("lo").to_numpy(), v.field("hi").to_numpy())
            edges = [0, *np.stack([lo, hi], axis=1).ravel().tolist(), len(text)]
            n_bytes.append(len(text))
            spans.append([{"lo": a, "hi": b} for a, b in zip(lo.tolist(), hi.tolist())])
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if len(lo) else text)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n_bytes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))), pa.array(kept, pa.binary())],
            ["id", "n_bytes", "spans", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (the maximal removed byte runs), kept (what is left)."""
    texts = keyed(docs)
    with tidy() as made:
        spans = written(_repeats(texts, length), "spans")
        made.remove(spans)
    cut = texts.join(spans, ["id", "text_hash"], "left").mapInArrow(_cut, _KEPT)
    return cut.select(shown_id().alias("doc_id"), "n_bytes", "spans", "kept")


def _repeats(texts: DataFrame, length: int) -> DataFrame:
    """id, text_hash, found: the spans (which may overlap) of each text that has repeated windows."""
    sampled = texts.mapInArrow(_sampled(length), _RUNS)

    # first round: sampled positions whose rank is unique go. The ranks that stay are written first:
    # as a table beside the join they leave Spark free to split a rank that very many positions have
    ranks = sampled.groupBy("rank").agg(F.count(F.lit(1)).alias("times"), F.min("context").alias("c0"), F.max("context").alias("c1")).filter("times > 1")
    ranks = written(few_files(ranks.select("rank", (F.col("c0") == F.col("c1")).alias("same")), "rank"), "ranks")
    repeated = written(sampled.join(ranks, "rank").select("rank", "context", "id", "text_hash", "lo", "n", "same"), "repeated")
    drop(ranks)

    # contexts that occur twice are repeated as a whole; one row of each context goes on
    open_ = repeated.filter("not same")
    contexts = open_.groupBy("rank", "context").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("id", "text_hash", "lo", "n")).alias("m"))
    contexts = written(contexts, "contexts")
    whole = repeated.filter("same").select("id", "text_hash", "lo", "n").union(
        open_.join(contexts.filter("times > 1").select("rank", "context"), ["rank", "context"], "left_semi").select("id", "text_hash", "lo", "n")
    )
    whole = whole.select("id", "text_hash", F.struct("lo", (F.col("lo") + F.col("n") + (length - 1)).alias("hi")).alias("span"))

    # last round: pairs of ranks half a threshold apart
    part = F.struct(F.col("m.lo").alias("lo"), F.col("m.n").alias("n"), (F.col("times") == 1).alias("alone"))
    parts = contexts.groupBy(F.col("m.id").alias("id"), F.col("m.text_hash").alias("text_hash")).agg(F.collect_list(part).alias("parts"))
    windows = texts.join(parts, ["id", "text_hash"]).mapInArrow(_doubled(length), _WINDOWS)
    twice = windows.groupBy("rank", "next_rank").agg(F.count(F.lit(1)).alias("times"), F.max("alone").alias("alone")).filter("times > 1 and alone")
    twice = written(few_files(twice.select("rank", "next_rank"), "rank", "next_rank"), "twice")
    found = windows.filter("alone").join(twice, ["rank", "next_rank"], "left_semi")
    found = found.select("id", "text_hash", F.struct(F.col("place").alias("lo"), (F.col("place") + length).alias("hi")).alias("span"))

    return whole.union(found).groupBy("id", "text_hash").agg(F.collect_list("span").alias("found"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    out = remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
    return few_files(out, "doc_id", "kept_sha256")
