"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words become numbers; one automaton holds every substring of every item. A
document's words are streamed through it: after each word the state knows the longest
suffix of the text that is in some item. Where that length reaches a window (13 words, or
all of a shorter item) the window's words are hit. A word that no item has sends the
automaton to its root, so only runs of item words as long as the shortest window are
streamed at all.

The automaton's size is checked: items are split into shards of about SHARD_WORDS words.
An item longer than a quarter of that is cut into parts under its item_id that overlap by a
window less one word, so that every window is whole in some part. Spark groups the parts by shard;
a task compiles each shard's automaton and writes it to the shared folder. The driver sees the
files' names only. A task that streams documents holds one automaton at a time: where there are
several it gathers a bounded number of bytes of text, streams them past each, and unites
the spans. Items are never sampled or dropped.

Words: A-Z folded, then runs of [0-9a-z] and non-ASCII bytes. A null text or item has no
words and no windows; an item without words is ignored; items with equal texts all count;
null item_ids are left out of the item list, as they have no name, but their words are
hit; a null or repeated doc_id is reported as it is; an empty benchmark hits nothing; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .tables import Folder, drop, keyed, order_id, read_table, shown_id, tidy, written

WINDOW = 13
SHARD_WORDS = 200_000
HELD = 32 << 20  # bytes of text that a task streams past all shards before it reads more
_PARTS = "name string, text string, n_words long"
_AUTOMATA = "shard long, path string, bytes long"
_SPAN = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])
_FOUND = "id long, text_hash long, n_words long, spans array<struct<lo:long,hi:long>>, items array<string>"


class ItemAutomaton:
    """Generalised suffix automaton over word numbers, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = [name for name, _ in items]
        self.short: dict[int, list[tuple[int, int]]] = {}  # state of a whole short item: (its length, item)
        finals, ends = [], set()  # (state, item) where a prefix of the item ends
        for number, (_, words) in enumerate(items):
            last = 0
            for w in words:
                last = self._extend(last, w)
                ends.add((last, number))
            finals.append(last)
        self._lay_out(np.array(sorted(ends), dtype=np.int64).reshape(-1, 2))
        for number, (_, words) in enumerate(items):
            if 0 < len(words) < window:
                self.short.setdefault(finals[number], []).append((len(words), number))
        # smallest length at which some window ends in the state or in one it links to
        self.least = [1 << 30] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            own = min([n for n, _ in self.short.get(v, [])], default=1 << 30)
            if self.length[v] >= window:
                own = min(own, window)
            self.least[v] = min(own, self.least[self.link[v]])

    def _lay_out(self, ends: np.ndarray) -> None:
        """Item numbers in the order of the link tree: those that end in a state or below it
        are one range, so a passage in many items is not repeated state by state."""
        n, link = len(self.link), self.link
        own = np.bincount(ends[:, 0], minlength=n)
        below, order = own.tolist(), sorted(range(1, n), key=self.length.__getitem__)
        for v in reversed(order):
            below[link[v]] += below[v]
        start, free = [0] * n, own.tolist()  # a state's own come first, then its children's ranges
        for v in order:
            start[v] = free[link[v]]
            free[link[v]] += below[v]
            free[v] += start[v]
        self.start, self.stop = np.array(start), np.array(start) + np.array(below)
        self.laid = np.zeros(len(ends), dtype=np.int32)
        before = np.arange(len(ends)) - (np.cumsum(own) - own)[ends[:, 0]]
        self.laid[self.start[ends[:, 0]] + before] = ends[:, 1]

    def items_below(self, state: int) -> list[int]:
        return np.unique(self.laid[self.start[state] : self.stop[state]]).tolist()

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length

        def clone(p: int, q: int) -> int:
            c = len(link)
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            link[q] = c
            while p >= 0 and nxt[p].get(w) == q:
                nxt[p][w] = c
                p = link[p]
            return c

        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else clone(last, q)
        state = len(link)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = state
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[state] = q if length[q] == length[p] + 1 else clone(p, q)
        return state

    def windows_at(self, state: int, matched: int, items: set[int], seen: set[int]) -> int:
        """Length of the longest window ending here; adds the items with a window ending here
        (`seen` has the states whose items are already among them)."""
        longest = 0
        while state > 0 and matched > 0:
            if self.length[state] >= self.window and matched >= self.window and self.length[self.link[state]] < self.window:
                longest = self.window  # the state of the last 13 words
                if state not in seen:
                    seen.add(state)
                    items.update(self.items_below(state))
            for n, item in self.short.get(state, ()):
                if n <= matched:
                    longest = max(longest, n)
                    items.add(item)
            state = self.link[state]
            matched = min(matched, self.length[state])
        return longest

    def scan(self, words: list[int], at: int, spans: list[tuple[int, int]], items: set[int]) -> None:
        """Stream word numbers that start at place `at`; append hit spans and item numbers."""
        nxt, link, length, least = self.next, self.link, self.length, self.least
        state, matched, seen = 0, 0, set()
        for i, w in enumerate(words):
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(w)
            if to is None:
                continue
            state = to
            matched += 1
            if matched >= least[state]:
                longest = self.windows_at(state, matched, items, seen)
                if longest:
                    spans.append((at + i + 1 - longest, at + i + 1))


def _compile(items: list[tuple[str | None, str]], window: int):
    """(sorted word hashes, automaton, length of the shortest window)."""
    texts = pa.array([t for _, t in items], pa.string())
    lists = []
    for _, offsets, buf in A.pieces(texts):
        starts, ends, rows = A.words(buf, offsets, A.NOT_ALNUM)
        hashes = A.span_hashes(buf, starts, ends)
        lists += [hashes[a:b] for a, b in zip(rows[:-1], rows[1:])]
    known = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.uint64)
    numbered = [(name, np.searchsorted(known, h).tolist()) for (name, _), h in zip(items, lists) if len(h)]
    shortest = min([min(window, len(w)) for _, w in numbered], default=window)
    return known, ItemAutomaton(numbered, window), shortest


def _parts(window: int, most: int):
    """Items (name, text) in parts of at most `most` words that overlap by a window less one."""

    def cut_items(batches):
        for batch in batches:
            names, texts, sizes = [], [], []
            for first, offsets, buf in A.pieces(batch.column("text")):
                starts, ends, rows = A.words(buf, offsets, A.NOT_ALNUM)
                for i, (lo, hi) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                    for a in range(lo, max(lo + 1, hi - window + 1), most - window + 1) if hi > lo else ():
                        z = min(a + most, hi)
                        names.append(batch.column("name")[first + i].as_py())
                        texts.append(buf[starts[a] : ends[z - 1]].tobytes().decode())
                        sizes.append(z - a)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], ["name", "text", "n_words"])

    return cut_items


def _build(folder: str, window: int):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        found, root = fs.FileSystem.from_uri(folder)
        found.create_dir(root, recursive=True)
        shard, name = int(rows["shard"].iloc[0]), f"{uuid.uuid4().hex}.automaton"  # of this attempt alone
        names = [None if pd.isna(n) else n for n in rows["name"]]
        data = pickle.dumps(_compile(list(zip(names, rows["text"])), window), protocol=pickle.HIGHEST_PROTOCOL)
        with found.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(data)
        return pd.DataFrame({"shard": [shard], "path": [f"{folder}/{name}"], "bytes": [len(data)]})

    return build


def compiled_items(benchmark: DataFrame, folder: str, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> list[str]:
    """Compile the items' automata below `folder`; their files' names, one per shard."""
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text")).filter("text is not null")
    parts = written(items.mapInArrow(_parts(window, max(window, shard_words // 4)), _PARTS).distinct(), "items")
    total = int(parts.agg(F.sum("n_words")).first()[0] or 0)
    n = max(1, -(-total // shard_words))
    while True:
        placed = parts.withColumn("shard", F.pmod(F.xxhash64("name", "text"), F.lit(n)))
        fullest = placed.groupBy("shard").agg(F.sum("n_words").alias("n")).agg(F.max("n")).first()[0] or 0
        if fullest <= 2 * max(shard_words, window):
            break
        n *= 2  # parts are distinct and a quarter of a shard at most
    built = written(placed.groupBy("shard").applyInPandas(_build(folder, window), _AUTOMATA), "automata")
    paths = [r["path"] for r in built.orderBy("shard").collect()]  # names, one per shard_words words of the benchmark
    drop(parts, built)
    return paths


_LOADED: dict[str, tuple] = {}  # the automaton in use


def _load(path: str):
    if path not in _LOADED:
        from pyarrow import fs

        _LOADED.clear()  # before the next one comes
        found, place = fs.FileSystem.from_uri(path)
        with found.open_input_file(place) as file:
            _LOADED[path] = pickle.loads(file.read())
    return _LOADED[path]


def _scan(shard, hashes, rows, spans, items) -> None:
    """Stream a piece's words past one shard; hit spans and item names per row."""
    known, automaton, shortest = shard
    if not (len(known) and len(hashes)):
        return
    number = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    inside = known[number] == hashes
    cut_here = np.zeros(len(inside) + 1, dtype=bool)
    cut_here[rows] = True
    begin = np.flatnonzero(inside & (cut_here[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (cut_here[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    long = end - begin >= shortest
    begin, end = begin[long], end[long]
    row = np.searchsorted(rows, begin, side="right") - 1
    found: dict[int, set[int]] = {}
    for b, e, r in zip(begin.tolist(), end.tolist(), row.tolist()):
        automaton.scan(number[b:e].tolist(), b - int(rows[r]), spans[r], found.setdefault(r, set()))
    for r, own in found.items():
        items[r] |= {automaton.names[i] for i in own} - {None}


def _held(batches, limit: int):
    """Lists of (id, text_hash, word hashes, word offsets of rows), each of about `limit` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for first, offsets, buf in A.pieces(batch.column("text")):
            starts, ends, rows = A.words(buf, offsets, A.NOT_ALNUM)
            n = len(offsets) - 1
            held.append((batch.column("id").slice(first, n), batch.column("text_hash").slice(first, n), A.span_hashes(buf, starts, ends), rows))
            size += len(buf)
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _stream(paths: list[str]):
    def stream(batches):
        A.enter("decontaminate", _LOADED.clear)
        for held in _held(batches, HELD if len(paths) > 1 else 1):
            spans = [[[] for _ in range(len(rows) - 1)] for *_, rows in held]
            items = [[set() for _ in range(len(rows) - 1)] for *_, rows in held]
            for path in paths:
                shard = _load(path)
                for (_, _, hashes, rows), s, i in zip(held, spans, items):
                    _scan(shard, hashes, rows, s, i)
            for (ids, text_hashes, _, rows), s, i in zip(held, spans, items):
                merged = []
                for own in s:
                    lo, hi = A.merge_spans(*np.array(own or np.zeros((0, 2)), dtype=np.int64).T)
                    merged.append([{"lo": a, "hi": b} for a, b in zip(lo.tolist(), hi.tolist())])
                names = pa.array([sorted(own) for own in i], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([ids, text_hashes, pa.array(np.diff(rows)), pa.array(merged, pa.list_(_SPAN)), names], ["id", "text_hash", "n_words", "spans", "items"])

    return stream


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: id, text_hash, n_words, spans (maximal hit word runs), items."""
    paths = compiled_items(benchmark, Folder(docs.sparkSession, "automata")._scratch, window, shard_words)
    return keyed(docs).mapInArrow(_stream(paths), _FOUND)


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = 5, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans, items, contaminated (hit words
    are at least `percent` of its words), text_hash."""
    found = find_contamination(docs, benchmark, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    found = found.withColumn("n_hit", hit)
    bad = (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))
    return found.select(shown_id().alias("doc_id"), "n_words", "n_hit", "spans", "items", bad.alias("contaminated"), "id", "text_hash")


def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
    """The texts without the words of the spans; what stands between spans stays as it is."""
    kept = []
    for own, found in zip(text, spans.to_pylist()):
        own = own.as_py()
        if own is not None and found:
            raw = own.encode()
            starts, ends, _ = A.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), A.NOT_ALNUM)
            edges = [0, *(x for s in found for x in (int(starts[s["lo"]]), int(ends[s["hi"] - 1]))), len(raw)]
            own = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])).decode()
        kept.append(own)
    return pa.array(kept, pa.string())


def without_contamination(docs: DataFrame, benchmark: DataFrame, percent: int = 5, window: int = WINDOW) -> DataFrame:
    """The input's rows and columns without the contaminated documents, and without the hit
    spans of the others; documents without a hit stay as they are."""
    with tidy() as made:  # the automata go once the documents have been streamed
        judged = decontaminate(docs, benchmark, percent, window).filter("n_hit > 0")
        hit = judged.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"), F.col("contaminated").alias("__bad"))
        hit = written(hit.dropDuplicates(["__id", "__hash"]), "hits")  # the documents are streamed once
        made.remove(hit)
    named = docs.withColumns({"__id": order_id(), "__hash": F.xxhash64(F.col("text"))})
    left = named.join(hit, ["__id", "__hash"], "left").filter("__bad is null or not __bad")
    clean, rest = left.filter("__bad is null").select(*docs.columns), left.filter("__bad is not null")
    shorter = F.arrow_udf(cut, T.StringType())(F.col("text").cast("string"), F.col("__spans"))
    return clean.union(rest.withColumn("text", shorter.cast(docs.schema["text"].dataType)).select(*docs.columns))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), bl AS (SELECT item_id, ws, CAST(least(len(ws), 13) AS BIGINT) AS l FROM b WHERE len(ws) > 0),
bw AS (
  SELECT DISTINCT item_id, l, array_to_string(list_slice(ws, i, i + l - 1), ' ') AS s
  FROM (SELECT item_id, ws, l, unnest(generate_series(1, len(ws) - l + 1)) AS i FROM bl)
), ls AS (SELECT DISTINCT l FROM bl),
dw AS (
  SELECT doc_id, l, i, array_to_string(list_slice(ws, i, i + l - 1), ' ') AS s
  FROM (SELECT doc_id, ws, l, unnest(generate_series(1, len(ws) - l + 1)) AS i FROM w, ls WHERE len(ws) >= l)
), m AS (SELECT doc_id, item_id, dw.l AS l, i FROM dw JOIN bw ON dw.l = bw.l AND dw.s = bw.s),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + l - 1)) AS j FROM m) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM m) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
