"""SentencePiece encoding and decoding by suffix-array matching.

A batch's text is indexed, not each text by itself: the segments of the batch (spaces,
signs, then letters and digits; no piece reaches further) that the worker has not met yet
are concatenated, and a suffix array over them is made by prefix doubling up to
the longest piece. Every piece of the vocabulary is then searched by bisection, all at
once, which gives its range of occurrences. These are edges (start, end, piece); sorted by
end position they are relaxed from left to right: an edge extends the encoding that ends
at its start if its piece can follow that encoding's last piece. For a BPE vocabulary
"can follow" means that the merges of the two pieces' joint text end in exactly these two;
then one edge at each position is left, and the path is the library's own encoding.
Segments that begin with several spaces, where many pieces share one score, and any
segment without a path, take the merges directly, over a heap (n log n).

Characters without a piece become their UTF-8 bytes' pieces. The vocabulary comes from a
model file whose path is a parameter; the driver reads it once and sends the pieces (a
fixed 32,000 here) to the tasks. Memory: GROUP bytes of text at a time, and at most CACHE
remembered segments.

A null text stays null (no ids: null); an empty text has no pieces; the space character
and U+2581 are one to the vocabulary, so the latter decodes as a space; very long texts
and segments are indexed whole; rows that repeat are encoded alike; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .tables import read_table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GROUP = 1 << 19  # characters of text whose segments are indexed together
CACHE = 200_000  # segments remembered by a Python worker
CACHED = 64  # characters of the longest segment remembered
INDEX = 1 << 17  # characters of segments in one suffix array, about
PACK = 5  # symbols (of 12 bits) compared at once
PAIRS = 1 << 20  # answers about pairs of pieces kept by a task
SHORT = 24  # characters; longer texts merge over a heap
_NONE, _ROOT = -2, -1  # no encoding ends here; start of a segment


class Vocabulary:
    """Pieces with a space for U+2581; ids of byte pieces by byte."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], size: int):
        self.pieces, self.byte_ids = pieces, byte_ids
        self.bytes_of = [b""] * size
        for piece, (i, _) in pieces.items():
            self.bytes_of[i] = piece.encode()
        for b, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([b])
        self.sizes = np.array([len(b) for b in self.bytes_of])
        self.flat = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.at = np.cumsum(self.sizes) - self.sizes

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i).replace("▁", " "): (i, sp.get_score(i)) for i in plain}
        return cls(pieces, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], n)


class Encoder:
    """Encodes the segments of one task; keeps what it has learnt."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        order = sorted(vocabulary.pieces)
        self.ids = np.array([vocabulary.pieces[p][0] for p in order])
        self.text_of = {vocabulary.pieces[p][0]: p for p in order}
        self.longest = max(map(len, order))
        self.code = {c: k + 2 for k, c in enumerate(sorted(set("".join(order))))}  # 0 ends a segment, 1 is any other character
        self.lengths = np.array([len(p) for p in order])
        self.grid = np.zeros((len(order), self.longest), dtype=np.int64)
        for k, p in enumerate(order):
            self.grid[k, : len(p)] = [self.code[c] for c in p]
        self.points = np.array(sorted(ord(c) for c in self.code))
        alone = np.fromiter((len(self.merges(p)) == 1 for p in order), dtype=bool, count=len(order))
        # pieces that no merge ends in occur in no encoding
        self.ids, self.lengths, self.grid = self.ids[alone], self.lengths[alone], self.grid[alone]
        self.pair_key, self.pair_ok = np.full(PAIRS, -1, dtype=np.int64), np.zeros(PAIRS, dtype=bool)
        self.known: dict[str, int] = {}  # segment -> its place in the store
        self.store, self.at, self.size, self.used = np.zeros(1 << 16, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        self.first = self._packed(np.concatenate([self.grid, np.zeros((len(self.grid), PACK), np.int64)], axis=1)[:, :PACK])
        self.segment = self._cuts(order)

    def _cuts(self, pieces: list[str]) -> re.Pattern:
        """Segments that no piece leaves: spaces, signs, then letters and digits. A cut lies
        before a space, around a character without a piece, and after a letter or digit that
        no piece has before a sign."""
        signs = {c for c in self.code if c != " " and not c.isalnum()}
        joined = {a for p in pieces for a, b in zip(p, p[1:]) if b in signs}
        word = {c for c in self.code if c.isalnum() and c not in joined}
        w, s = ("".join(map(re.escape, sorted(x))) for x in (word, set(self.code) - word - {" "}))
        return re.compile(f" *[{s}]*[{w}]+| *[{s}]+| +|[^ {s}{w}]")

    def merges(self, text: str) -> list[str]:
        """Plain BPE: the best-scored neighbours merge, the leftmost on ties."""
        return self._few_merges(text) if len(text) <= SHORT else self._many_merges(text)

    def _few_merges(self, text: str) -> list[str]:
        parts, pieces = list(text), self.v.pieces
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = pieces.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found[1] > best):
                    best, at = found[1], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _many_merges(self, text: str) -> list[str]:
        """The same over a heap of possible merges and links between neighbours, n log n. A
        part that has been merged only grows, so an entry still holds if its text does."""
        parts: list[str | None] = list(text)
        n, pieces = len(parts), self.v.pieces
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))

        def entry(i):
            joint = parts[i] + parts[after[i]]
            found = pieces.get(joint)
            return None if found is None else (-found[1], i, joint)

        heap = [e for e in map(entry, range(n - 1)) if e is not None]
        heapify(heap)
        while heap:
            _, i, joint = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[i] + parts[j] != joint:
                continue
            parts[i], parts[j], after[i] = joint, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (e := entry(k)) is not None:
                    heappush(heap, e)
        return [p for p in parts if p is not None]

    def _spelled(self, parts: list[str]) -> list[int]:
        out = []
        for p in parts:
            found = self.v.pieces.get(p)
            out.extend([found[0]] if found else [self.v.byte_ids[b] for b in p.encode()])
        return out

    def _follows(self, keys: np.ndarray) -> np.ndarray:
        """For pairs a << 20 | b: whether piece b can follow piece a. Answers are kept in a
        table with one place per hash; a pair that lost its place is worked out again."""
        place = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) & np.uint64(PAIRS - 1)).astype(np.int64)
        miss = self.pair_key[place] != keys
        if miss.any():
            new, first = np.unique(keys[miss], return_index=True)
            at = place[miss][first]
            answers = np.fromiter((self._can_follow(int(k) >> 20, int(k) & 0xFFFFF) for k in new), dtype=bool, count=len(new))
            self.pair_key[at], self.pair_ok[at] = new, answers
            out = self.pair_ok[place]
            lost = self.pair_key[place] != keys  # two new pairs of one place
            if lost.any():
                out[lost] = answers[np.searchsorted(new, keys[lost])] if np.isin(keys[lost], new).all() else [self._can_follow(int(k) >> 20, int(k) & 0xFFFFF) for k in keys[lost]]
            return out
        return self.pair_ok[place]

    def _can_follow(self, a: int, b: int) -> bool:
        x, y = self.text_of[a], self.text_of[b]
        return x + y not in self.v.pieces and self.merges(x + y) == [x, y]

    @staticmethod
    def _packed(codes: np.ndarray) -> np.ndarray:
        """PACK codes as one number that sorts like them."""
        out = np.zeros(len(codes), dtype=np.int64)
        for j in range(PACK):
            out = out << 12 | codes[:, j]
        return out

    def _edges(self, codes: np.ndarray):
        """All (start, end, piece) at which a piece occurs."""
        n = len(codes)
        padded = np.concatenate([codes, np.zeros(self.longest + PACK, np.int64)])
        key = self._packed(np.stack([padded[j : n + j] for j in range(PACK)], axis=1))
        rank, h = np.unique(key, return_inverse=True)[1].astype(np.int64), PACK
        while h < self.longest:  # prefix doubling
            ahead = np.zeros(n, np.int64)
            ahead[: max(n - h, 0)] = rank[h:] + 1
            rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1].astype(np.int64)
            h *= 2
        suffixes = np.argsort(rank, kind="stable")
        # bisect for all pieces: the first PACK symbols as one number, then one by one
        key = key[suffixes]
        open_ = (1 << 12 * np.maximum(PACK - self.lengths, 0)) - 1
        lo, hi = np.searchsorted(key, self.first), np.searchsorted(key, self.first | open_, side="right")
        for depth in range(PACK, self.longest):
            live = np.flatnonzero((self.lengths > depth) & (lo < hi))
            want = self.grid[live, depth]
            bounds = []
            for upper in (False, True):
                a, b = lo[live].copy(), hi[live].copy()
                while (going := a < b).any():
                    mid = (a + b) >> 1
                    seen = padded[suffixes[np.minimum(mid, n - 1)] + depth]
                    right = (seen <= want if upper else seen < want) & going
                    a = np.where(right, mid + 1, a)
                    b = np.where(going & ~right, mid, b)
                bounds.append(a)
            lo[live], hi[live] = bounds
        times = np.maximum(hi - lo, 0)
        piece = np.repeat(np.arange(len(self.ids), dtype=np.int32), times)
        place = np.repeat((lo - (np.cumsum(times) - times)).astype(np.int32), times)
        place += np.arange(len(place), dtype=np.int32)
        start = suffixes.astype(np.int32)[place]
        return start, start + self.lengths.astype(np.int32)[piece], self.ids.astype(np.int32)[piece]

    def learn(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number) of the segments, one after the other. Edges are sorted by the
        place of their end in the segment, and all segments are relaxed together, place by place."""
        text = "\0".join(segments)
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        codes = np.where(self.points[at] == points, at + 2, 1)
        lengths = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        begins = np.cumsum(lengths + 1) - lengths - 1
        codes[begins[1:] - 1] = 0  # the separators, whatever characters the text has
        start, end, piece = self._edges(codes)
        depth = end - np.repeat(begins.astype(np.int32), lengths + 1)[start]
        order = np.argsort(depth, kind="stable").astype(np.int32)
        start, end, piece = start[order], end[order], piece[order]
        del order
        last, back = np.full(len(codes) + 1, _NONE, dtype=np.int64), np.zeros(len(codes) + 1, dtype=np.int64)
        last[begins] = _ROOT
        cuts = np.concatenate([[0], np.cumsum(np.bincount(depth))]) if len(depth) else [0]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            s, e, p = start[lo:hi], end[lo:hi], piece[lo:hi]
            before = last[s]
            ok = before != _NONE
            pairs = np.flatnonzero(before >= 0)
            ok[pairs] = self._follows(before[pairs] << 20 | p[pairs])
            last[e[ok]], back[e[ok]] = p[ok], s[ok]

        # the paths, from the ends of all segments at once
        ends = begins + lengths
        plain = (last[ends] != _NONE) & (lengths > 0)
        plain &= np.fromiter((not s.startswith("  ") for s in segments), dtype=bool, count=len(segments))
        of, now, found = np.flatnonzero(plain), ends[plain], []
        while len(of):
            found.append((of, last[now]))
            now = back[now]
            more = now > begins[of]
            of, now = of[more], now[more]
        of = np.concatenate([o for o, _ in found[::-1]]) if found else np.zeros(0, np.int64)
        ids = np.concatenate([i for _, i in found[::-1]]) if found else np.zeros(0, np.int64)
        # several spaces, characters without a piece: the merges themselves
        rest = [(k, self._spelled(self.merges(segments[k]))) for k in np.flatnonzero(~plain).tolist()]
        of = np.concatenate([of, *(np.full(len(x), k) for k, x in rest)]) if rest else of
        ids = np.concatenate([ids, *(np.array(x, dtype=np.int64) for _, x in rest)]) if rest else ids
        order = np.argsort(of, kind="stable")
        return ids[order].astype(np.int32), np.bincount(of, minlength=len(segments))

    def _remember(self, segments: list[str]) -> None:
        ids, size = self.learn(segments)
        if self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store[: self.used], np.zeros(max(self.used, len(ids)) + (1 << 16), np.int32)])
        self.store[self.used : self.used + len(ids)] = ids
        base = len(self.at)
        self.at = np.concatenate([self.at, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.known.update(zip(segments, range(base, base + len(segments))))
        self.used += len(ids)

    def _forget(self, entries: int, used: int, segments: list[str]) -> None:
        for s in segments:
            del self.known[s]
        self.at, self.size, self.used = self.at[:entries], self.size[:entries], used

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row offsets) of the texts; null as empty."""
        split = [self.segment.findall(" " + t.replace("▁", " ")) if t else [] for t in texts]
        count = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        total = int(count.sum())
        place = np.fromiter(map(self.known.get, chain.from_iterable(split), repeat(-1)), dtype=np.int64, count=total)
        entries, used, new, missing = len(self.at), self.used, [], np.flatnonzero(place < 0)
        if len(missing):
            flat = list(chain.from_iterable(split))
            unknown = [flat[i] for i in missing.tolist()]
            new = list(dict.fromkeys(unknown))
            for block in _blocks([s for s in new if len(s) <= CACHED], INDEX):
                self._remember(block)
            for s in new:  # a long one by itself, so that its places do not lengthen the others'
                if len(s) > CACHED:
                    self._remember([s])
            place[missing] = np.fromiter(map(self.known.__getitem__, unknown), dtype=np.int64, count=len(unknown))
        size = self.size[place]
        ids = self.store[np.repeat(self.at[place] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        rows = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
        if len(self.known) > CACHE or any(len(s) > CACHED for s in new):
            self._forget(entries, used, new)
        return ids, rows


def _blocks(segments: list[str], limit: int):
    """Runs of segments of about `limit` characters."""
    first, size = 0, 0
    for i, s in enumerate(segments):
        size += len(s) + 1
        if size >= limit:
            yield segments[first : i + 1]
            first, size = i + 1, 0
    if first < len(segments):
        yield segments[first:]


def _grouped(column, limit: int):
    """Slices of rows of about `limit` characters."""
    group, size, first = [], 0, 0
    for i, value in enumerate(column):
        text = value.as_py()
        group.append(text)
        size += len(text or "")
        if size >= limit:
            yield first, group
            group, size, first = [], 0, i + 1
    if group:
        yield first, group


_ENCODERS: dict[int, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """The worker's encoder for this vocabulary; the next task on the worker goes on with it."""
    name = hash(tuple(vocabulary.pieces))
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(vocabulary)
    return _ENCODERS[name]


def _encode(vocabulary, columns):
    def encode(batches):
        A.enter("pieces", _ENCODERS.clear)
        encoder = _encoder(vocabulary.value)
        for batch in batches:
            for first, group in _grouped(batch.column("text"), GROUP):
                part = batch.slice(first, len(group))
                ids, rows = encoder.encode(group)
                null = pa.array([t is None for t in group])
                lists = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids), mask=null)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), lists], [*columns, "ids"])

    return encode


def _texts(v: Vocabulary, ids: np.ndarray, rows: np.ndarray, null: np.ndarray) -> pa.Array:
    """The texts of id lists."""
    size = v.sizes[ids]
    out = v.flat[np.repeat(v.at[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))].tobytes()
    ends = np.concatenate([[0], np.cumsum(size)])[rows].tolist()
    return pa.array([None if no else out[a + 1 : b].decode(errors="replace") for a, b, no in zip(ends[:-1], ends[1:], null.tolist())], pa.string())


def _decode(vocabulary, columns):
    def decode(batches):
        A.enter("pieces", _ENCODERS.clear)
        v = vocabulary.value
        for batch in batches:
            for first in range(0, len(batch), 500):
                part = batch.slice(first, 500)
                lists = part.column("ids")
                rows, ids = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
                texts = _texts(v, ids, rows - rows[0], ~np.array(lists.is_valid()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), texts], [*columns, "decoded"])

    return decode


def _both_ways(vocabulary, columns):
    """Encoded and, from the ids, decoded again, in one worker."""

    def both(batches):
        A.enter("pieces", _ENCODERS.clear)
        v = vocabulary.value
        encoder = _encoder(v)
        for batch in batches:
            for first, group in _grouped(batch.column("text"), GROUP):
                part = batch.slice(first, len(group))
                ids, rows = encoder.encode(group)
                null = np.array([t is None for t in group])
                lists = pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids), mask=pa.array(null))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), lists, _texts(v, ids, rows, null)], [*columns, "ids", "decoded"])

    return both


def _schema(df: DataFrame, *added: str):
    from pyspark.sql import types as T

    kind = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}
    return T.StructType([*(f for f in df.schema.fields if f.name not in added), *(T.StructField(c, kind[c]) for c in added)])


def _shared(df: DataFrame, model: str):
    return df.sparkSession.sparkContext.broadcast(Vocabulary.read(model))


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """The input's columns and `ids`, the pieces of `text`."""
    docs = docs.drop("ids")
    return docs.mapInArrow(_encode(_shared(docs, model), docs.columns), _schema(docs, "ids"))


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """The input's columns and `decoded`, the text of `ids`."""
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(_decode(_shared(encoded, model), encoded.columns), _schema(encoded, "decoded"))


def both_ways(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """decode(encode(docs)) in one pass."""
    docs = docs.drop("ids", "decoded")
    return docs.mapInArrow(_both_ways(_shared(docs, model), docs.columns), _schema(docs, "ids", "decoded"))


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text, ids, decoded."""
    return both_ways(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)


def op2_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(read_table(spark, sf_dir, "documents"))
    same = F.col("decoded").eqNullSafe(F.replace(F.col("text"), F.lit("▁"), F.lit(" ")))
    return out.select(
        "doc_id", "ids", F.size(F.coalesce("ids", F.array().cast("array<int>"))).cast("long").alias("n_pieces"), F.sha2("decoded", 256).alias("decoded_sha256"), same.alias("round_trip")
    )
