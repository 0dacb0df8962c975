"""Hard negatives by Four-Russians scoring.

An inner product of integers is a sum over bits: with a candidate's components written in
two's complement, bit plane b weighs 2**b (the sign plane minus that), and the eight bits
of eight neighbouring components in one plane are one byte. For an anchor and each group
of eight components a table holds the sums of all 256 subsets of its components, so a byte looks up
what eight components add. The planes are taken from the highest down, the sum doubled
before each (shift and add): exact integer scores without a multiplication.

Candidates are packed into blocks of at most BLOCK rows (planes, ids, labels, in order of
id), dealt round robin, so no label, id or repeated vector makes a hot task. Anchors are
packed into blocks of at most ANCHORS; a copy of each goes to every part of the candidates,
and a block meets a block: the stated anchors against all rows. No pair of rows is ever
a row of a table. Each block gives its best few per anchor, and a window with a limit
keeps the best of all. First the positives; then, with the bands that their scores give,
the negatives.

Another row is a row with another id. A row whose label or vector is null, or with a null or
non-finite component, takes no part; a null id is no anchor and comes last among ties; a
shorter vector counts as zeros beyond its end; rows that repeat count each time as
candidates, and an anchor that repeats exactly is mined once (rows that share only the id
are mined each); an anchor without another row of its label has no result; an empty table
gives an empty result; a component over 2**20 after scaling is an error; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import read_table, written
from .vectors import matrix, quantized, usable

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
GROUP = 8  # components looked up together
BLOCK, ANCHORS = 4096, 128  # rows of a block
PART = 16 * BLOCK  # rows of a part, at most about
MOST = 1 << 20
LAST = (1 << 63) - 1  # stands for a null id
_PLACE = 12  # bits of a place in a block
_CANDIDATES = "part int, size int, bits int, ids binary, labels binary, planes binary"
_ANCHORS = "ids binary, hashes binary, labels binary, width int, vectors binary, scores binary"
_FOUND = "anchor long, anchor_hash long, slot int, score long, other long"


def planes_of(vectors: np.ndarray) -> np.ndarray:
    """bits x groups x rows: the bytes of all bit planes, the sign plane last."""
    n, width = vectors.shape
    bits = int(np.abs(vectors).max(initial=0)).bit_length() + 1
    padded = np.zeros((n, -(-width // GROUP) * GROUP), dtype=np.int64)
    padded[:, :width] = vectors
    out = np.empty((bits, padded.shape[1] // GROUP, n), dtype=np.uint8)
    for b in range(bits):
        out[b] = np.packbits((padded >> b & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def tables_of(anchors: np.ndarray, groups: int, dtype) -> np.ndarray:
    """groups x 256 x anchors: the sum of every subset of each eight components."""
    own = np.zeros((len(anchors), groups * GROUP), dtype=dtype)
    width = min(anchors.shape[1], own.shape[1])
    own[:, :width] = anchors[:, :width]
    out = np.zeros((groups, 1 << GROUP, len(anchors)), dtype=dtype)
    for i in range(GROUP):
        out[:, 1 << i : 2 << i] = out[:, : 1 << i] + own[:, i::GROUP].T[:, None, :]
    return out


def scores(planes: np.ndarray, anchors: np.ndarray, step: int = 1024) -> np.ndarray:
    """rows x anchors: exact inner products."""
    bits, groups, n = planes.shape
    most = int(np.abs(anchors).sum(axis=1).max(initial=0)) << bits
    if most >> (62 - _PLACE):
        raise ValueError("scores would leave 64 bits")
    dtype = np.int32 if most < 1 << 31 else np.int64
    tables = tables_of(anchors, groups, dtype)
    out = np.zeros((n, len(anchors)), dtype=dtype)
    spare = np.empty((min(step, n), len(anchors)), dtype=dtype)
    for lo in range(0, n, step):
        acc = out[lo : lo + step]
        buf = spare[: len(acc)]
        for b in range(bits - 1, -1, -1):
            acc <<= 1
            for g in range(groups):
                np.take(tables[g], planes[b, g, lo : lo + step], axis=0, out=buf, mode="clip")
                if b == bits - 1:
                    acc -= buf
                else:
                    acc += buf
    return out


def _candidates(batches):
    """Blocks of a part's rows, in order of id."""
    part = TaskContext.get().partitionId()
    for batch in batches:
        for first in range(0, len(batch), BLOCK):
            own = batch.slice(first, BLOCK)
            ids = own.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            planes = planes_of(matrix(own.column("vector"))[order])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([len(own)], pa.int32()), pa.array([len(planes)], pa.int32()), pa.array([ids[order].tobytes()], pa.binary()),
                    pa.array([own.column("label").to_numpy()[order].tobytes()], pa.binary()), pa.array([planes.tobytes()], pa.binary()),
                ],
                ["part", "size", "bits", "ids", "labels", "planes"],
            )


def _anchors(batches):
    for batch in batches:
        for first in range(0, len(batch), ANCHORS):
            own = batch.slice(first, ANCHORS)
            vectors, positive = matrix(own.column("vector")), own.column("scores")
            slots = np.full((len(own), POSITIVES), np.iinfo(np.int64).min, dtype=np.int64)
            for i, found in enumerate(positive.to_pylist()):
                slots[i, : len(found)] = found
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([own.column(c).to_numpy().tobytes()], pa.binary()) for c in ("id", "hash", "label")), pa.array([vectors.shape[1]], pa.int32()),
                    pa.array([vectors.tobytes()], pa.binary()), pa.array([slots.tobytes()], pa.binary()),
                ],
                ["ids", "hashes", "labels", "width", "vectors", "scores"],
            )


def _best(keys: np.ndarray, most: int) -> np.ndarray:
    """The greatest keys, falling."""
    if len(keys) > most:
        keys = np.partition(keys, len(keys) - most)[-most:]
    return np.sort(keys)[::-1]


def _scored(row: dict):
    """(anchor ids, hashes, slots, candidate ids; by anchor: keys, which are other rows of its
    label, and of another). A key sorts by score, then by the smaller place, the smaller id."""

    def numbers(name, kind=np.int64):
        return np.frombuffer(row[name], dtype=kind)

    ids, labels = numbers("ids"), numbers("labels")
    own, hashes, own_labels = numbers("anchor_ids"), numbers("anchor_hashes"), numbers("anchor_labels")
    planes = numbers("planes", np.uint8).reshape(row["bits"], -1, row["size"])
    found = scores(planes, numbers("vectors").reshape(len(own), row["width"]))
    keys = np.ascontiguousarray(found.T).astype(np.int64)
    keys <<= _PLACE
    keys |= (row["size"] - 1 - np.arange(row["size"]))[None, :]
    other, same = ids[None, :] != own[:, None], labels[None, :] == own_labels[:, None]
    return own, hashes, numbers("scores").reshape(len(own), POSITIVES), ids, keys, other & same, other & ~same


def _rows(out: list, size: int, ids: np.ndarray):
    """Record batch of (anchor, hash, slot, keys) lists."""
    count = [len(k) for *_, k in out]
    keys = np.concatenate([k for *_, k in out]) if out else np.zeros(0, np.int64)
    anchor, hash_, slot = (np.repeat(np.array([x[i] for x in out], dtype=np.int64), count) for i in range(3))
    other = ids[size - 1 - (keys & ((1 << _PLACE) - 1))] if len(keys) else keys
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor), pa.array(hash_), pa.array(slot.astype(np.int32)), pa.array(keys >> _PLACE), pa.array(other)], ["anchor", "anchor_hash", "slot", "score", "other"]
    )


def _positives(most: int):
    def find(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own, hashes, _, ids, keys, same, _ = _scored(row)
                yield _rows([(own[a], hashes[a], 0, _best(keys[a, same[a]], most)) for a in range(len(own))], row["size"], ids)

    return find


def _negatives(most: int, low: int, high: int):
    def find(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own, hashes, slots, ids, keys, _, differ = _scored(row)
                out = []
                for a in range(len(own)):
                    known = [int(s) for s in slots[a] if s > np.iinfo(np.int64).min]
                    bands = [(-(-low * s // 100) << _PLACE, (high * s // 100 + 1) << _PLACE) for s in known]  # keys from, up to
                    if not bands:
                        continue
                    mine = keys[a]
                    inside = mine[(mine >= min(lo for lo, _ in bands)) & (mine < max(hi for _, hi in bands)) & differ[a]]
                    inside.sort()
                    for slot, (lo, hi) in enumerate(bands):
                        to = np.searchsorted(inside, hi)
                        best = inside[max(np.searchsorted(inside, lo), to - most) : to]
                        if len(best):
                            out.append((own[a], hashes[a], slot, best))
                yield _rows(out, row["size"], ids)

    return find


def _met(blocks: DataFrame, parts: int, anchors: DataFrame, n_anchors: int, find) -> DataFrame:
    """What `find` gives for every block of candidates with every block of anchors."""
    packed = anchors.repartition(max(1, -(-n_anchors // ANCHORS))).mapInArrow(_anchors, _ANCHORS)
    names = {c: f"anchor_{c}" for c in ("ids", "hashes", "labels")}
    packed = packed.withColumnsRenamed(names).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return blocks.join(packed, "part").drop("part").mapInArrow(find, _FOUND)


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "anchor_hash", "slot").orderBy(F.col("score").desc(), "other")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def mine(
    rows: DataFrame, anchors: DataFrame, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. `anchors` are
    rows of the same columns. For each anchor and each of its first `positives` other rows of
    its label: the first `negatives` rows of another label whose score is `low` to `high`
    percent of the positive's."""
    if positives > POSITIVES:
        raise ValueError(f"at most {POSITIVES} positives")

    def numbered(df):
        df = df.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
        df = df.filter(F.col("label").isNotNull() & usable(F.col("vector")))
        return df.select(F.coalesce("id", F.lit(LAST)).alias("id"), "label", quantized(F.col("vector"), scale, MOST).alias("vector"))

    candidates = numbered(rows)
    n, cores = candidates.count(), rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(4 * cores, -(-n // 512)), -(-n // PART))
    blocks = written(candidates.repartition(parts).mapInArrow(_candidates, _CANDIDATES), "candidates")

    own = numbered(anchors).filter(F.col("id") != LAST).withColumn("hash", F.xxhash64("label", "vector"))
    own = written(own.dropDuplicates(["id", "hash"]), "anchors")
    n_anchors = own.count()
    no_scores = F.array().cast("array<long>").alias("scores")
    found = _ranked(_met(blocks, parts, own.select("*", no_scores), n_anchors, _positives(positives)), positives)
    found = written(found.select("anchor", "anchor_hash", (F.col("place") - 1).alias("slot"), F.col("score").alias("positive_score"), F.col("other").alias("positive")), "positives")

    by_anchor = found.groupBy(F.col("anchor").alias("id"), F.col("anchor_hash").alias("hash"))
    by_anchor = by_anchor.agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).getField("positive_score").alias("scores"))  # at most `positives`
    banded = own.join(by_anchor, ["id", "hash"])
    best = _ranked(_met(blocks, parts, banded, n_anchors, _negatives(negatives, low, high)), negatives)

    def shown(c):
        return F.when(F.col(c) != LAST, F.col(c))

    return best.join(found, ["anchor", "anchor_hash", "slot"]).select(
        F.col("anchor").alias("anchor_id"), shown("positive").alias("positive_id"), F.col("place").alias("rank"), shown("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(rows, rows.filter("vec_id % 100 = 0"))


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), s AS MATERIALIZED (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid AS other, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON b.vec_id IS DISTINCT FROM a.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor, anchor_id, other, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY score DESC, other_id NULLS LAST) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
