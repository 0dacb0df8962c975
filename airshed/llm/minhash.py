"""Near-duplicate documents by circulant MinHash.

Two permutations of the 64-bit integers: the first scatters the shingles, the second,
circularly shifted by k, gives coordinate k of the signature, so one pair makes all
coordinates. Signatures are banded; documents that share a band are compared on their
full shingle sets, and links are closed into components.

Scale: texts with the same shingle set become one class first (an aggregate that
combines map-side), so thousands of copies cost one member. A bucket is never gathered or
paired out: its most central member is joined with the others. Where a bucket then still
holds several components, classes are left out if too many of their shingles are in no
other open class to reach the similarity with any; what remains is joined with a centre
again, and only pairs in different components whose common shingles could suffice are
compared directly; a full bucket is dealt to blocks, and each two blocks meet by themselves.
No link is lost by this: each test is a bound on the intersection.
Components are found by star contraction joins, written down each round.

Nulls and empty texts have no shingles and link with nothing; a null doc_id comes after
every id; rows that repeat a doc_id share its verdict only if their texts do; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A
from .tables import keyed, order_id, read_table, shown_id, tidy, written

SHINGLE = 5
ROWS, MISS = 5, 4.5e-7  # a pair at the similarity asked for shares no band with this probability at most
PIECE = 1 << 19
BLOCK = 512  # members of a bucket that meet in a task at most, about; all blocks meet
_SIGMA, _PI = A.U(0xA24BAED4963EE407), A.U(0xE7037ED1A0B428DB)
_SIGNATURES = "id long, text_hash long, n_shingles long, class binary, bands array<long>"
_SETS = "class binary, shingles array<long>"


def bands(percent: int) -> int:
    """The fewest bands that miss a pair at `percent` with probability MISS at most (25 at 85)."""
    at = (percent / 100) ** ROWS
    return 1 if at >= 1 else math.ceil(math.log(MISS) / math.log1p(-at))


def shingle_sets(column: pa.Array):
    """(first row, set offsets, distinct shingle hashes, sorted within each row) piece by piece."""
    for first, offsets, buf in A.pieces(column, PIECE):
        starts, ends, rows = A.words(buf, offsets, A.SPACE)
        hashes = A.span_hashes(buf, starts, ends)
        sets = []
        for lo, hi in zip(rows[:-1].tolist(), rows[1:].tolist()):
            own = hashes[lo:hi]
            sets.append(np.unique(A.grams(own, min(SHINGLE, len(own)) or 1)))
        sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
        yield first, np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(sets) if sets else np.zeros(0, np.uint64)


def _pi(y: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation, in place (its upper bits decide the minimum)."""
    np.right_shift(y, A.U(32), out=spare)
    y ^= spare
    y *= _PI
    np.right_shift(y, A.U(29), out=spare)
    y ^= spare
    y *= _SIGMA
    return y


def signatures(offsets: np.ndarray, shingles: np.ndarray, size: int) -> np.ndarray:
    """size x rows: the smallest pi(sigma(x) + k) of each row's shingles, k = 0, 1, ..."""
    filled = np.flatnonzero(np.diff(offsets))
    out = np.zeros((size, len(offsets) - 1), dtype=np.uint64)
    if len(filled):
        base, at = A.mix(shingles * _SIGMA), offsets[:-1][filled]
        shifted, spare = np.empty_like(base), np.empty_like(base)
        for k in range(size):
            np.add(base, A.U(k), out=shifted)  # the circular shift, modulo 2**64
            out[k, filled] = np.minimum.reduceat(_pi(shifted, spare), at)
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """rows x bands: one hash per band, the band's number included."""
    bands = len(signature) // rows
    keys = np.empty((bands, signature.shape[1]), dtype=np.uint64)
    for b in range(bands):
        key = np.full(signature.shape[1], A.U(b + 1), dtype=np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            key = A.mix(key * A._C + signature[r])
        keys[b] = key
    return keys.T


def _class_keys(offsets: np.ndarray, shingles: np.ndarray) -> pa.Array:
    """128 bits that name a shingle set: two sums of scattered members."""
    total = []
    for salt in (A.U(0x632BE59BD9B4E019), A.U(0x9FB21C651E98DF25)):
        part = np.concatenate([[A.U(0)], np.cumsum(A.mix(shingles ^ salt))])
        total.append(part[offsets[1:]] - part[offsets[:-1]])
    raw = np.ascontiguousarray(np.stack(total, axis=1)).tobytes()
    n = len(offsets) - 1
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * 16).astype(np.int32).tobytes()), pa.py_buffer(raw)])


def _sign(n_bands: int):
    def sign(batches):
        A.enter("minhash")
        for batch in batches:
            for first, offsets, shingles in shingle_sets(batch.column("text")):
                n = len(offsets) - 1
                keys = band_keys(signatures(offsets, shingles, n_bands * ROWS))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, n), batch.column("text_hash").slice(first, n), pa.array(np.diff(offsets)),
                        _class_keys(offsets, shingles), A.long_lists(keys.ravel(), np.arange(n + 1) * n_bands),
                    ],
                    ["id", "text_hash", "n_shingles", "class", "bands"],
                )

    return sign


def _sets(batches):
    for batch in batches:
        for first, offsets, shingles in shingle_sets(batch.column("text")):
            yield pa.RecordBatch.from_arrays([batch.column("class").slice(first, len(offsets) - 1), A.long_lists(shingles, offsets)], ["class", "shingles"])


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their full sets' intersection and union."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    joined = pairs.join(right, "b").join(left, "a")
    joined = joined.select("a", "b", F.size(F.array_intersect("set_a", "set_b")).alias("both"), (F.size("set_a") + F.size("set_b")).alias("sum"))
    return written(joined.select("a", "b", "both", (F.col("sum") - F.col("both")).alias("union")), "measured")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node reachable. Large-star and small-star rounds
    as joins and aggregates; the edges are written down each round."""

    def links(df, a, b):
        return df.select(F.col(a).alias("u"), F.col(b).alias("v"))

    def state(df):
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links")
    seen = state(now)
    for _ in range(most_rounds):
        if seen[0] == 0:
            break
        both = now.union(links(now, "v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(links(least, "u", "m"))
        now = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "links")
        seen, last = state(now), seen
        if seen == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())


def _members(classes: DataFrame) -> DataFrame:
    """Members of buckets of two or more: key, class, n, weight. The weight sums the sizes of
    a class's buckets; among near copies the least changed one has the greatest."""
    buckets = classes.select("class", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = buckets.join(sizes, "key")
    weights = members.groupBy("class").agg(F.sum("size").alias("weight"))
    return written(members.drop("size").join(weights, "class"), "buckets")


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Bucket members with their component."""
    own = roots.select(F.col("node").alias("class"), "root")
    return members.drop("root").join(own, "class", "left").withColumn("root", F.coalesce("root", "class"))


def _unsettled(members: DataFrame) -> DataFrame:
    """Members of the buckets that still hold two components."""
    open_keys = members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi")
    return members.join(open_keys.select("key"), "key", "left_semi")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; id and text_hash, which
    name its text, and group, which names its component (null without shingles)."""
    with tidy() as made:
        out = written(_verdicts(docs, percent), "verdicts")
        made.remove(out)
    return out


def _verdicts(docs: DataFrame, percent: int) -> DataFrame:
    texts = keyed(docs)
    signed = written(texts.mapInArrow(_sign(bands(percent)), _SIGNATURES), "signatures")
    classes = written(
        signed.filter("n_shingles > 0").groupBy("class").agg(F.min(F.struct("id", "text_hash", "n_shingles", "bands")).alias("m")).select("class", "m.*"), "classes"
    )
    members = _members(classes)

    def similar_sizes(a, b):  # sets this different in size cannot reach the similarity
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    def with_hub(of):  # the weightiest class of each bucket
        return of.join(of.groupBy("key").agg(F.max(F.struct("weight", "class", "n")).alias("hub")), "key")

    def pair(x, y):
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    def stars(of):  # it with every other
        rays = of.filter(F.col("class") != F.col("hub.class")).filter(similar_sizes(F.col("n"), F.col("hub.n")))
        return rays.select(*pair("class", "hub.class")).distinct()

    def links(of):
        return of.filter(100 * F.col("both") >= percent * F.col("union")).select("a", "b")

    touched = classes.join(members.select("class").distinct(), "class", "left_semi").select("class", "id", "text_hash")
    found = texts.join(touched, ["id", "text_hash"]).select("class", "text").mapInArrow(_sets, _SETS)
    sets = written(found.groupBy("class").agg(F.first("shingles").alias("shingles")), "sets")  # once, if rows repeat

    tried = measured(written(stars(with_hub(members)), "pairs"), sets)
    roots = components(links(tried))

    # buckets that still hold several components: leave out classes too few of whose
    # shingles are in any other open class, then stars again
    left = _unsettled(_labelled(members, roots))
    open_sets = sets.join(left.select("class").distinct(), "class", "left_semi").select("class", F.explode("shingles").alias("shingle"))
    lonely = open_sets.groupBy("shingle").agg(F.count(F.lit(1)).alias("in"), F.min("class").alias("class")).filter("in = 1")
    alone = lonely.groupBy("class").agg(F.count(F.lit(1)).alias("alone"))
    left = left.join(alone, "class", "left").withColumn("common", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")
    left = left.withColumn("weight", F.floor(1_000_000 * F.col("common") / F.col("n")))  # the centre now: the class with the least of its own
    left = written(with_hub(_unsettled(left.filter(100 * F.col("common") >= percent * F.col("n")))), "unsettled")
    tried = tried.union(measured(written(stars(left).join(tried, ["a", "b"], "left_anti"), "pairs"), sets))
    roots = components(links(tried))

    # then every open pair that could suffice. What two classes share lies in their hub or
    # outside it; both parts are bounded, as their intersections with the hub are known
    left = _unsettled(_labelled(left, roots)).withColumn("__hub", F.col("hub.class"))
    known = tried.select("a", "b", F.col("both").alias("in_hub"))
    left = left.withColumns(dict(zip("ab", pair("class", "__hub")))).join(known, ["a", "b"], "left")
    in_hub = F.when(F.col("class") == F.col("__hub"), F.col("n")).otherwise(F.col("in_hub"))
    left = left.withColumn("in_hub", in_hub).select("key", "class", "n", "root", "common", "in_hub")
    # blocks: members of a full bucket meet block by block, each two blocks in a task of their own
    last = left.groupBy("key").agg((F.ceil(F.count(F.lit(1)) / BLOCK) - 1).alias("last"))
    left = written(left.join(last, "key").withColumn("block", F.pmod(F.xxhash64("class"), F.col("last") + 1)), "unsettled")
    x = left.withColumn("hi", F.explode(F.sequence("block", "last"))).withColumnRenamed("block", "lo").alias("x")
    y = left.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), "block"))).withColumnRenamed("block", "hi").alias("y")
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.lo") == F.col("y.lo")) & (F.col("x.hi") == F.col("y.hi"))
    once = (F.col("x.lo") < F.col("x.hi")) | (F.col("x.class") < F.col("y.class"))
    parts = F.least("x.in_hub", "y.in_hub") + F.least(F.col("x.common") - F.col("x.in_hub"), F.col("y.common") - F.col("y.in_hub"))
    known_both = F.col("x.in_hub").isNotNull() & F.col("y.in_hub").isNotNull()
    bound = F.when(known_both, F.least(parts, "x.common", "y.common")).otherwise(F.least("x.common", "y.common"))
    enough = (100 + percent) * bound >= percent * (F.col("x.n") + F.col("y.n"))
    cross = x.join(y, met & once & (F.col("x.root") != F.col("y.root")) & enough)
    rest = written(cross.select(*pair("x.class", "y.class")).distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    roots = components(links(tried.union(measured(rest, sets))))

    smallest = classes.select("class", "id").join(roots, F.col("class") == F.col("node"), "left").select("class", "id", F.coalesce("root", "class").alias("root"))
    component = smallest.groupBy("root").agg(F.min("id").alias("component"))
    of_class = smallest.join(component, "root").select("class", "component", "root")
    out = signed.drop("bands").join(of_class, "class", "left").withColumn("component", F.coalesce("component", "id"))
    return out.select(
        shown_id().alias("doc_id"), "n_shingles", shown_id("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"), "id", "text_hash", F.col("root").alias("group")
    )


def without_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The input's rows without near duplicates: of each component one row stays, that of
    its smallest id (of rows that repeat an id, one of them); rows without words all stay."""
    has_words = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = near_duplicates(docs, percent).filter("kept and group is not null").groupBy("group").agg(F.min(F.struct("id", "text_hash")).alias("m"))
    named = docs.filter(has_words).withColumns({"__id": order_id(), "__hash": F.xxhash64(F.col("text"))})
    kept = named.join(first.select(F.col("m.id").alias("__id"), F.col("m.text_hash").alias("__hash")), ["__id", "__hash"], "left_semi")
    return kept.dropDuplicates(["__id", "__hash"]).select(*docs.columns).union(docs.filter(~has_words))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * p.n_both >= 85 * (na.n + nb.n - p.n_both)
), r(doc_id, reach) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a
), c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
