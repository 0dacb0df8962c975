"""Packing by powers of two.

A document's token ids and a closing END are cut from the front into pieces of `limit` ids
and then, by the binary digits of what is left, into pieces of falling powers of two. Each piece is
a sequence by itself, so no sequence holds two documents, and as its length is a power of
two it is not padded. Sequences of one length form a bucket; a batch is drawn from one
bucket, its number of sequences times its length being the same for all (write_buckets,
batch_size).

It is one map: tokens leave Python as little-endian unsigned 32-bit bytes, one column per
piece, and nothing is shuffled. A sequence's number holds the number of its task and its
place there, which are unique within one evaluation; write_buckets writes them down.

Ids are those of the tokenizers library for the whole text and the given file. Where the
file's merges allow it (_by_rank proves that on its vocabulary) the same file is run by
tiktoken, which gives the same ids several times faster; texts that hold one of the file's
special strings, and files of another kind, go through tokenizers itself. Memory: GROUP
characters of text at a time, a longer text alone.

A null or empty text has the one piece [END]; very long texts and segments are encoded
whole; rows that repeat are packed each time; null and repeated doc_ids are passed on; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .tables import read_table

TOKENIZER = "byte_bpe_50k.json"
LIMIT, END = 1024, 0
GROUP = 1 << 20  # characters of text encoded together
# fixed value: how byte-level BPE splits a text
SEGMENTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECES = "doc_id {}, start long, length int, tokens binary, doc_tokens long, sequence_id long, offset int"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _by_rank(definition: dict, library):
    """tiktoken with the file's vocabulary, or None where its ids could differ. tiktoken joins the
    neighbours whose joint token has the least id, tokenizers those of the first merge. If ids follow the
    merges and every token by itself is encoded as itself, these are the same: two neighbours x, y
    with a token xy were made by the merges that the text xy alone makes, which go on to xy."""
    import tiktoken

    model, split = definition["model"], definition.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not definition.get("normalizer")
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if not plain or model.get("type", "BPE") != "BPE" or any(model.get(k) for k in odd):
        return None
    byte_of, vocabulary = _byte_of(), model["vocab"]
    special = {t.content for t in library.get_added_tokens_decoder().values()}
    tokens = {w: i for w, i in vocabulary.items() if w not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    joined = [tokens.get(x + y, -1) for x, y in merges]
    if joined != sorted(joined) or -1 in joined or not all(c in byte_of for w in tokens for c in w) or not all(c in tokens for c in byte_of):
        return None
    if any([t.value for t in library.model.tokenize(w)] != [w] for w in tokens):
        return None
    ranks = {bytes(byte_of[c] for c in w): i for w, i in tokens.items()}
    return tiktoken.Encoding("packing", pat_str=SEGMENTS, mergeable_ranks=ranks, special_tokens={})


class TokenIds:
    """The tokenizers library's ids of whole texts, without its special tokens around them."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import tokenizers

        self.library = tokenizers.Tokenizer.from_str(definition)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.by_rank = _by_rank(json.loads(definition), self.library)

    def encode(self, text: str) -> np.ndarray:
        if self.by_rank is not None and not any(s in text for s in self.special):
            try:
                return self.by_rank.encode_to_numpy(text)
            except ValueError:  # a run of spaces too long for its pattern matcher
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def decomposition(n: int, limit: int = LIMIT) -> list[int]:
    """Lengths of the pieces of n ids, in their order."""
    rest = n % limit
    return [limit] * (n // limit) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


_WORKERS: dict[int, TokenIds] = {}


def _token_ids(definition: str) -> TokenIds:
    """The worker's own, which the next task on it finds again."""
    name = hash(definition)
    if name not in _WORKERS:
        _WORKERS.clear()
        _WORKERS[name] = TokenIds(definition)
    return _WORKERS[name]


def _grouped(column: pa.Array):
    """(first row, texts) of about GROUP characters; null as empty."""
    group, size, first = [], 0, 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        group.append(text)
        size += len(text)
        if size >= GROUP:
            yield first, group
            group, size, first = [], 0, i + 1
    if group:
        yield first, group


def _pack(definition, limit: int, end: int):
    def pack(batches):
        A.enter("packing", _WORKERS.clear)
        token_ids, task, number = _token_ids(definition.value), TaskContext.get().partitionId() << 33, 0
        last = np.array([end], dtype=np.uint32)
        for batch in batches:
            for first, group in _grouped(batch.column("text")):
                encoded = [token_ids.encode(text) for text in group]
                tokens = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded)) + 1
                ids = np.concatenate(list(chain.from_iterable((own, last) for own in encoded)), dtype="<u4")
                cut = [decomposition(n, limit) for n in tokens.tolist()]
                count = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
                length = np.fromiter(chain.from_iterable(cut), dtype=np.int64, count=int(count.sum()))
                begin = np.concatenate([[0], np.cumsum(length)])
                row = np.repeat(np.arange(len(group)), count)
                start = begin[:-1] - (np.cumsum(tokens) - tokens)[row]
                for lo in range(0, len(length), 1 << 16):  # Arrow's binary offsets are 32 bits
                    hi = min(lo + (1 << 16), len(length))
                    own = ids[begin[lo] : begin[hi]]
                    offsets = ((begin[lo : hi + 1] - begin[lo]) * 4).astype(np.int32)
                    raw = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(own.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array(row[lo:hi] + first)), pa.array(start[lo:hi]), pa.array(length[lo:hi].astype(np.int32)), raw,
                            pa.array(tokens[row[lo:hi]]), pa.array(task + number + np.arange(hi - lo)), pa.array(np.zeros(hi - lo, np.int32)),
                        ],
                        ["doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"],
                    )
                    number += hi - lo

    return pack


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pack(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, end: int = END) -> DataFrame:
    """One row per piece, which is a sequence: doc_id, start, length (its bucket), tokens
    (little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset (0). `limit` is a
    power of two. `tokenizer`: path of its file, which the driver reads."""
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    with open(tokenizer or tokenizer_path(), encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_pack(definition, limit, end), _PIECES.format(texts.schema["doc_id"].dataType.simpleString()))


def write_buckets(packed: DataFrame, path: str) -> DataFrame:
    """The sequences in a folder per length, with files by size; read back."""
    packed.withColumn("bucket", F.col("length")).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    return packed.sparkSession.read.parquet(path)


def batch_size(length: int, batch_tokens: int) -> int:
    """Sequences of a bucket in a batch of `batch_tokens` ids (a power of two): every batch
    then costs the same, whatever bucket it is drawn from."""
    return max(1, batch_tokens // length)


def op12_pack_powers_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(read_table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset")
    )
