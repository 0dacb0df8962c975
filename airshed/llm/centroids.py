"""Clustering around centroids with ns-bounds.

Rounds of assignment and averaging in exact integers, but most distances are never computed. A
vector keeps, for each centroid, its squared distance when it was last measured and the
round of that measurement; all earlier centroids are kept (rounds x k vectors, a fixed
size). When a bound is needed, the old distance is loosened by the norm of the centroid's
whole displacement since then: the norm of a sum of moves, which is at most, and mostly
far below, the sum of the norms of the moves of each round. A vector whose own centroid is nearer than
the loosened distance of every other stays where it is. For the others the distance to
the own centroid is measured, then those to the centroids whose bounds still fail, and
these exact integers decide (ties: the smaller number). Square roots are only compared
with a margin above their rounding, so a bound never decides what the integers would not.

In Spark a round is one map over the vectors (written down, the round before it dropped) and
one aggregate of the vectors that changed sides, added to and taken from exact sums; no
vector is shuffled, no cluster is gathered, and k sums reach the driver. Rounds in which
no centroid moves are skipped, as they would change nothing.

A vector with another number of components than asked for, or a null or non-finite one,
is left out, a null vector too; a null id takes part but starts no centroid; rows that
repeat count each time, and equal starting vectors are centroids of their own (the later
one stays empty); fewer vectors than centroids give fewer centroids; an empty table gives an
empty result; a component of more than 2**27 after scaling is an error; other columns are
ignored. A row is a few hundred bytes, however long the table's other columns are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import drop, read_table, written
from .vectors import matrix, quantized, usable

K, ROUNDS, SCALE, DIMENSIONS, SALT = 8, 10, 1024, 64, "3"
MOST = 1 << 27  # a squared distance of 64 components stays below 2**63
PAIRS = 1 << 14  # vector and centroid pairs measured at once
_MARGIN = 1e-12  # relative; far above the rounding of a square root and a sum
_STATE = "id long, vector array<int>, cluster int, before int, near array<long>, seen array<smallint>, measured int"


def _squares(vectors: np.ndarray, centroids: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Exact squared distances of the pairs (rows[i], cols[i])."""
    out = np.empty(len(rows), dtype=np.int64)
    for lo in range(0, len(rows), PAIRS):
        gap = vectors[rows[lo : lo + PAIRS]] - centroids[cols[lo : lo + PAIRS]]
        out[lo : lo + PAIRS] = np.einsum("ij,ij->i", gap, gap)
    return out


def displacements(history: np.ndarray) -> np.ndarray:
    """rounds x k: how far each centroid now lies from where it lay in each round."""
    gap = history[-1][None] - history
    return np.sqrt((gap * gap).sum(axis=2).astype(np.float64))


def assign(vectors: np.ndarray, history: np.ndarray, cluster: np.ndarray, near: np.ndarray, seen: np.ndarray, exact: bool = False):
    """(cluster, number of distances measured by row) under the last centroids of the
    history; near and seen are brought up to date in place. `cluster` of -1: not assigned
    yet. `exact`: the own distance is measured for all."""
    now, k, n = len(history) - 1, history.shape[1], len(vectors)
    centroids, moved = history[-1], displacements(history)
    measured = np.zeros(n, dtype=np.int32)
    row, number = np.arange(n), np.arange(k)

    def measure(rows, cols):
        near[rows, cols] = _squares(vectors, centroids, rows, cols)
        seen[rows, cols] = now
        np.add.at(measured, rows, 1)

    new = np.flatnonzero(cluster < 0)
    measure(np.repeat(new, k), np.tile(number, len(new)))
    own = np.where(cluster < 0, 0, cluster)
    if exact:
        stale = row[seen[row, own] != now]
        measure(stale, own[stale])

    def failing(rows):
        far = np.sqrt(near[rows].astype(np.float64))
        drift = moved[seen[rows], number]
        upper, lower = (far + drift) * (1 + _MARGIN), far * (1 - _MARGIN) - drift * (1 + _MARGIN)
        at = np.arange(len(rows))
        out = upper[at, own[rows]][:, None] >= lower
        out[at, own[rows]] = False
        return out

    open_ = row[failing(row).any(axis=1)]
    stale = open_[seen[open_, own[open_]] != now]
    measure(stale, own[stale])
    fails = failing(open_)
    at, cols = np.nonzero(fails & (seen[open_] != now))
    measure(open_[at], cols)
    fails[np.arange(len(open_)), own[open_]] = True  # all of these are exact now
    out = own.astype(np.int32)
    out[open_] = np.where(fails, near[open_], np.iinfo(np.int64).max).argmin(axis=1)
    if exact:
        stale = row[seen[row, out] != now]
        measure(stale, out[stale])
    return out, measured


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(values).ravel()))


def _round(shared, exact: bool):
    def step(batches):
        history = shared.value
        k = history.shape[1]
        for batch in batches:
            if len(batch) == 0:
                continue
            vectors = matrix(batch.column("vector"), history.shape[2])
            cluster = batch.column("cluster").to_numpy()
            if (cluster < 0).all():
                near, seen = np.zeros((len(batch), k), np.int64), np.zeros((len(batch), k), np.int16)
            else:
                near, seen = matrix(batch.column("near"), k), matrix(batch.column("seen"), k).astype(np.int16)
            now, measured = assign(vectors, history, cluster, near, seen, exact)
            measured += batch.column("measured").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(now), pa.array(cluster), _lists(near), _lists(seen), pa.array(measured)],
                ["id", "vector", "cluster", "before", "near", "seen", "measured"],
            )

    return step


def _changes(k: int):
    """Sums of the vectors that came to a cluster, less those that left it; their number last."""

    def sums(batches):
        for batch in batches:
            if len(batch) == 0:
                continue
            vectors = matrix(batch.column("vector"))
            vectors = np.concatenate([vectors, np.ones((len(vectors), 1), np.int64)], axis=1)
            total = np.zeros((k, vectors.shape[1]), np.int64)
            for column, sign in (("cluster", 1), ("before", -1)):
                of = batch.column(column).to_numpy()
                np.add.at(total, of[of >= 0], sign * vectors[of >= 0])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), _lists(total)], ["cluster", "sums"])

    return sums


def start_order(vec_id: Column, salt: str = SALT) -> Column:
    """What the starting vectors are chosen by: the smallest first."""
    return F.sha2(F.concat(F.lit(f"{salt}:"), vec_id.cast("string")), 256)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dimensions: int = DIMENSIONS, salt: str = SALT, vec_id: str = "vec_id", vector: str = "embedding"):
    """(one row per vector: vec_id, cluster, distance (squared), measured (distances computed for
    it in all rounds); the final centroids, as integers, by number)."""
    spark = vectors.sparkSession
    v = F.col(vector)
    kept = vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("vector")).filter(usable(F.col("vector")) & (F.size("vector") == dimensions))
    kept = kept.select("id", quantized(F.col("vector"), scale, MOST).alias("vector"))
    first = kept.filter("id is not null").orderBy(start_order(F.col("id"), salt), "vector").limit(k).collect()
    if not first:
        return kept.limit(0).select(F.col("id").alias("vec_id"), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).alias("measured")), []
    centroids = [list(r["vector"]) for r in first]
    k, history = len(centroids), [centroids]
    sums = [[0] * (dimensions + 1) for _ in centroids]
    state = kept.select("id", "vector", F.lit(-1).alias("cluster"), F.lit(-1).alias("before"), F.array().cast("array<long>").alias("near"), F.array().cast("array<smallint>").alias("seen"), F.lit(0).alias("measured"))

    def assigned(of, last, name):
        shared = spark.sparkContext.broadcast(np.array(history, dtype=np.int64))
        out = written(of.mapInArrow(_round(shared, last), _STATE).select(*(["id", "cluster", "near", "measured"] if last else of.columns)), name)
        if of is not kept_state:
            drop(of)
        return out

    kept_state = state
    for _ in range(rounds):
        state = assigned(state, False, "assigned")
        changed = state.filter("cluster != before").mapInArrow(_changes(k), "cluster int, sums array<long>")
        changed = changed.select("cluster", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("part"))
        for r in changed.collect():  # k rows of sums
            sums[r["cluster"]][r["at"]] += int(r["part"])
        centroids = [[s // own[-1] for s in own[:-1]] if own[-1] else list(old) for own, old in zip(sums, centroids)]
        if centroids == history[-1]:
            break
        history.append(centroids)
    state = assigned(state, True, "clustered")
    out = state.select(F.col("id").alias("vec_id"), "cluster", F.element_at("near", F.col("cluster") + 1).alias("distance"), "measured")
    return out, centroids


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, centroids = cluster(read_table(spark, sf_dir, "embeddings"))
    totals = {r["cluster"]: r["total"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # at most K rows

    def of_cluster(values, kind):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values] or [F.lit(None).cast(kind)]), F.col("cluster") + 1)

    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return out.select(
        "vec_id", "cluster", "distance",
        of_cluster([totals.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(totals.values())).cast("long").alias("inertia"), of_cluster(names, "string").alias("centroid_sha256"),
    )


def _oracle() -> str:
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, q FROM (
    SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
    WHERE len(embedding) = {DIMENSIONS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMENSIONS}
  )
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS k, q AS c FROM (
    SELECT sha256('{SALT}:' || CAST(vec_id AS VARCHAR)) AS h, q FROM v WHERE vec_id IS NOT NULL ORDER BY h, q LIMIT {K}
  )
)""",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, min(d * {K} + k) AS best FROM (
    SELECT rid, k, list_sum([(q[i] - c[i]) * (q[i] - c[i]) FOR i IN range(1, {DIMENSIONS + 1})])::HUGEINT AS d FROM v, c{r}
  ) GROUP BY rid
)""")  # fmt: skip
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c FROM c{r} LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM (
      SELECT k, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
        SELECT CAST(best % {K} AS BIGINT) AS k, unnest(q) AS x, unnest(range(1, {DIMENSIONS + 1})) AS i FROM a{r} JOIN v USING (rid)
      ) GROUP BY k, i
    ) GROUP BY k
  ) USING (k)
)""")
    last = f"(SELECT vec_id, CAST(best % {K} AS INTEGER) AS cluster, CAST(best // {K} AS BIGINT) AS distance FROM a{ROUNDS} JOIN v USING (rid))"
    return f"""WITH {", ".join(steps)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM {last} JOIN c{ROUNDS} ON k = cluster"""


ORACLE = _oracle()
