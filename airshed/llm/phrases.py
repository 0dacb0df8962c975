"""Removal of repeated word passages with sharded Aho-Corasick automata.

A word goes if some window of 13 words that covers it also starts in a document with a
smaller id; the first document that holds a passage keeps it.

1. Confirm what recurs. Windows are represented by sampled seeds (sampling.py); a seed in
   one document only cannot belong to a recurring window. Seeds are counted with a
   map-side combine.
2. Documents with recurring seeds are cut into segments, the words of the windows around
   one seed, named by seed and hash; the smallest id that holds each is found by an
   aggregate, so a passage in a third of all documents is one row. A segment that an
   earlier document holds goes whole.
3. Where a seed has several segments, their windows must be compared. Each such segment's
   words are read once, from its first holder, and go to a shard by seed. There the windows
   in two or more segments are confirmed, compiled into an automaton (pyahocorasick, one
   letter per distinct word), and every segment is streamed through it by ascending id; the
   first occurrence names a window's holder, the later ones are repeats. The number of shards
   follows the number of segments. A seed with more than HOT segments (a passage in very
   many surroundings) would overfill a shard; its windows are matched by an aggregate on the
   window's words instead, which holds no group in memory.
4. Each document joins what was found and drops the covered words.

A null text has no words; a null doc_id comes after all others (in an order fixed by the
text); rows that repeat a doc_id do not count as smaller than each other; texts of fewer
words than a window are left alone; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .sampling import runs
from .tables import key_filter, keyed, may_hold, read_table, shown_id, written

WINDOW = 13
SEED = 4  # words
HOT = 2_000  # segments of one seed; beyond, windows are matched by an aggregate
SHARD = 50_000  # segments in a shard, about
_SEEDS = "seed long, id long"
_OCCURRENCES = "seed long, segment_hash long, id long, text_hash long, lo long, n int"
_SEGMENTS = "seed long, hot boolean, segment_hash long, segment binary, id long"
_LOCATED = "seed long, segment_hash long, holders array<long>"
_KEPT = "id long, n_words long, n_removed long, kept string"


def _runs(offsets, buf, window: int):
    """(runs, their segments' hashes, their rows, row offsets)."""
    starts, ends, rows = A.words(buf, offsets, A.SPACE, fold=False)
    hashes = A.span_hashes(buf, starts, ends, fold=False)
    r = runs(A.grams(hashes, SEED), rows, window, SEED)
    segments = A.spans_of(A.prefix_items(hashes), r.first, r.last + window)
    return r, segments, np.searchsorted(rows, r.first, side="right") - 1, rows


def _own(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    return A.mix(keys + A.mix(row.astype(np.uint64) + A.U(1)))


def _seeds(window: int):
    def find(batches):
        for batch in batches:
            ids = batch.column("id")
            for first, offsets, buf in A.pieces(batch.column("text")):
                r, _, row, _ = _runs(offsets, buf, window)
                once = np.unique(_own(r.seed, row), return_index=True)[1]
                yield pa.RecordBatch.from_arrays([A.longs(r.seed[once]), ids.take(pa.array(row[once] + first))], ["seed", "id"])

    return find


def _occurrences(window: int, known):
    def find(batches):
        for batch in batches:
            for first, offsets, buf in A.pieces(batch.column("text")):
                r, segments, row, rows = _runs(offsets, buf, window)
                take = np.flatnonzero(may_hold(known.value, r.seed))
                src = pa.array(row[take] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        A.longs(r.seed[take]), A.longs(segments[take]), batch.column("id").take(src), batch.column("text_hash").take(src),
                        pa.array(r.first[take] - rows[row[take]]), pa.array((r.last - r.first + 1)[take].astype(np.int32)),
                    ],
                    ["seed", "segment_hash", "id", "text_hash", "lo", "n"],
                )

    return find


def _segments(window: int):
    """The words of the segments that the rows' lists `wanted` name, each once per row."""

    def cut(batches):
        for batch in batches:
            for first, offsets, buf in A.pieces(batch.column("text")):
                n = len(offsets) - 1
                wanted = batch.column("wanted").slice(first, n)
                of = np.repeat(np.arange(n), np.diff(wanted.offsets.to_numpy()))
                names = wanted.flatten()
                seed, segment = (names.field(c).to_numpy().view(np.uint64) for c in ("seed", "segment_hash"))
                keys = _own(seed + A.mix(segment.copy()), of)
                r, segments, row, rows = _runs(offsets, buf, window)
                mine, once = np.unique(_own(r.seed + A.mix(segments.copy()), row), return_index=True)
                order = np.argsort(keys)
                at = order[np.minimum(np.searchsorted(keys, mine, sorter=order), len(order) - 1)]
                held = keys[at] == mine
                take, at = once[held], at[held]
                by_place = np.argsort(take)
                take, hot = take[by_place], names.field("hot").to_numpy(zero_copy_only=False).astype(bool)[at[by_place]]
                out, last, split = [], -1, []
                for i, a, b in zip(row[take].tolist(), (r.first - rows[row])[take].tolist(), (r.last - rows[row] + window)[take].tolist()):
                    if i != last:
                        split, last = buf[offsets[i] : offsets[i + 1]].tobytes().split(), i
                    out.append(b" ".join(split[a:b]))
                yield pa.RecordBatch.from_arrays(
                    [A.longs(r.seed[take]), pa.array(hot), A.longs(segments[take]), pa.array(out, pa.binary()), batch.column("id").take(pa.array(row[take] + first))],
                    ["seed", "hot", "segment_hash", "segment", "id"],
                )

    return cut


def _letters(segments: list[list[bytes]]):
    """Each segment as a string with one letter per distinct word; two letters per word (from
    disjoint halves, so matches stay aligned) when a shard has more words than there are letters."""
    names: dict[bytes, int] = {}
    numbers = [[names.setdefault(w, len(names)) for w in s] for s in segments]
    skip = 0xE000  # letters start after the surrogates
    if len(names) < 0x110000 - skip:
        return ["".join(map(chr, (x + skip for x in s))) for s in numbers], 1
    half = (0x110000 - skip) // 2
    return ["".join(chr(skip + x // half) + chr(skip + half + x % half) for x in s) for s in numbers], 2


def _recurring(texts: list[str], size: int, width: int) -> list[str]:
    """The windows that are in two or more of the segments."""
    seen: set[str] = set()
    again: set[str] = set()
    for text in texts:
        own = {text[j : j + size] for j in range(0, len(text) - size + 1, width)}
        again |= own & seen
        seen |= own
    return list(again)


def _locate(window: int):
    def shard(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        held = table.column("id").to_pylist()
        texts, width = _letters([s.split() for s in table.column("segment").to_pylist()])
        size = window * width
        found = [[own] * ((len(t) - size) // width + 1) for t, own in zip(texts, held)]
        confirmed = _recurring(texts, size, width)
        if confirmed:
            automaton = ahocorasick.Automaton()
            for i, w in enumerate(confirmed):
                automaton.add_word(w, i)
            automaton.make_automaton()
            first = [None] * len(confirmed)  # smallest id that holds it: ids ascend
            for text, own, out in zip(texts, held, found):
                for end, i in automaton.iter(text):
                    if first[i] is None:
                        first[i] = own
                    out[(end + 1 - size) // width] = first[i]
        return pa.table({"seed": table.column("seed"), "segment_hash": table.column("segment_hash"), "holders": pa.array(found, pa.list_(pa.int64()))})

    return shard


def _drop(window: int):
    def drop(batches):
        for batch in batches:
            hashes, found = batch.column("text_hash"), batch.column("found")
            n_words, n_removed, kept = [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                split = (text.as_py() or b"").split()
                gone = np.zeros(len(split) + 1, np.int64)
                if found[i].is_valid:
                    v = found[i].values
                    mine = v.field("text_hash").to_numpy() == hashes[i].as_py()
                    at = v.field("at").to_numpy()[mine]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + v.field("n").to_numpy()[mine] + (window - 1), -1)
                    left = [w for w, g in zip(split, np.cumsum(gone[:-1])) if not g]
                else:
                    left = split
                n_words.append(len(split))
                n_removed.append(len(split) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"])

    return drop


def remove_repeated_phrases(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words left, one space between)."""
    texts = keyed(docs)
    counted = texts.mapInArrow(_seeds(window), _SEEDS).groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    recurring = written(counted.select("seed"), "seeds")
    known = docs.sparkSession.sparkContext.broadcast(key_filter(recurring, "seed"))  # 8 MB
    occurrences = written(texts.mapInArrow(_occurrences(window, known), _OCCURRENCES).join(recurring, "seed", "left_semi"), "occurrences")
    first = occurrences.groupBy("seed", "segment_hash").agg(F.min("id").alias("holder"))
    several = first.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed", (F.col("n") > HOT).alias("hot"))
    first = written(first.join(several, "seed", "left").withColumn("several", F.col("hot").isNotNull()), "first")
    shards = max(1, -(-first.filter("not hot").count() // SHARD))

    name = F.struct("seed", "hot", "segment_hash")
    wanted = first.filter("several").groupBy(F.col("holder").alias("id")).agg(F.collect_list(name).alias("wanted"))
    segments = written(texts.join(wanted, "id").mapInArrow(_segments(window), _SEGMENTS).dropDuplicates(["seed", "segment_hash"]), "segments")

    shard = F.pmod(F.xxhash64("seed"), F.lit(shards))
    located = segments.filter("not hot").withColumn("shard", shard).groupBy("shard").applyInArrow(_locate(window), _LOCATED)

    parts = F.split(F.col("segment").cast("string"), " ")
    every = F.transform(F.sequence(F.lit(1), F.size("words") - (window - 1)), lambda i: F.array_join(F.slice("words", i, window), " "))
    hot = segments.filter("hot").select("seed", "segment_hash", "id", parts.alias("words")).select("seed", "segment_hash", "id", F.posexplode(every).alias("at", "phrase"))
    least = hot.groupBy("seed", "phrase").agg(F.min("id").alias("holder"))
    hot = hot.join(least, ["seed", "phrase"]).groupBy("seed", "segment_hash").agg(F.sort_array(F.collect_list(F.struct("at", "holder"))).alias("all"))
    located = written(located.union(hot.select("seed", "segment_hash", F.col("all.holder").alias("holders"))), "located")

    held = occurrences.join(first.select("seed", "segment_hash", "holder", "several"), ["seed", "segment_hash"])
    whole = held.filter("holder < id").select("id", F.struct("text_hash", F.col("lo").alias("at"), "n").alias("hit"))
    open_ = held.filter("holder = id and several").join(located, ["seed", "segment_hash"])
    places = F.transform("holders", lambda holder, j: F.when(holder < F.col("id"), F.struct("text_hash", (F.col("lo") + j).alias("at"), F.lit(1).alias("n"))))
    partial = open_.select("id", F.explode(F.filter(places, lambda p: p.isNotNull())).alias("hit"))
    found = whole.union(partial).groupBy("id").agg(F.collect_list("hit").alias("found"))
    out = texts.join(found, "id", "left").mapInArrow(_drop(window), _KEPT)
    return out.select(shown_id().alias("doc_id"), "n_words", "n_removed", "kept")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_phrases(read_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w WHERE len(ws) >= 13)
), first_in AS (SELECT s, min(doc_id) AS holder FROM win GROUP BY s),
hit AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i FROM win JOIN first_in USING (s) WHERE holder < doc_id
), pos AS (
  SELECT doc_id, ws[i] AS word, i FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM w WHERE len(ws) > 0)
), left_over AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept, count(*) AS n FROM pos p LEFT JOIN hit h ON h.doc_id = p.doc_id AND h.i = p.i WHERE h.i IS NULL GROUP BY p.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(l.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(l.kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over l USING (doc_id)
"""
