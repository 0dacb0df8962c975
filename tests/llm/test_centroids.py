"""Centroid clusters against plain rounds over all distances."""

import hashlib
import math
import os

import duckdb
import numpy as np
import pytest

from airshed.llm import centroids as C

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int"


def brute(rows, k, rounds, dim, scale=1024):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds if cents else 0):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(cents)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = sorted((i is None, i or 0, *nearest(v)[::-1]) for i, v in kept) if cents else []
    return out, cents


def got(spark, rows, k=4, rounds=6, dim=3):
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA).repartition(3)
    out, cents = C.cluster(df, k=k, rounds=rounds, dimensions=dim)
    found = out.collect()
    return sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in found), cents, found


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_rounds(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 3))
    rows = [(i, [float(np.float32(x)) for x in centres[rng.integers(5)] + rng.normal(size=3) * 0.3]) for i in range(200)]
    out, cents, found = got(spark, rows, k=4, rounds=8)
    assert (out, cents) == brute(rows, 4, 8, 3)
    assert sum(r.measured for r in found) < 0.6 * len(rows) * 4 * 9  # most distances are never computed


def test_left_out_rows_ties_repeats_and_null_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [1.0, nan, 2.0]), (6, [inf, 0.0, 0.0]), (7, [1.0, 2.0, 3.0, 4.0])]
    assert got(spark, rows)[:2] == ([], [])
    rows += [(None, [9.0, 0.0, 0.0]), (None, [9.0, 0.0, 0.0])]
    assert got(spark, rows)[:2] == ([], [])  # a null id starts no centroid
    rows += [(8, [0.5, 0.0, 0.0])]
    assert got(spark, rows)[0] == brute(rows, 4, 6, 3)[0] and len(got(spark, rows)[1]) == 1
    rows += [(8, [0.5, 0.0, 0.0]), (8, [-0.5, 0.0, 0.0]), (9, [0.0, 1.5, -0.0001]), (10, [0.0, -1.5, 0.0]), (11, [0.0, 0.0, 0.0]), (-12, [-3.0, 2.0, 2.0])]
    for k in (2, 4, 8):
        assert got(spark, rows, k=k)[:2] == brute(rows, k, 6, 3)


def test_bounds_never_decide_what_integers_would_not():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-4, 5, size=(500, 2))  # many exact ties
    history = [rng.integers(-4, 5, size=(6, 2)) for _ in range(7)]
    cluster = np.full(500, -1)
    near, seen = np.zeros((500, 6), np.int64), np.zeros((500, 6), np.int16)
    for r in range(7):
        cluster, _ = C.assign(vectors, np.array(history[: r + 1]), cluster, near, seen, exact=r == 6)
        d = ((vectors[:, None] - history[r][None]) ** 2).sum(axis=2)
        assert (cluster == d.argmin(axis=1)).all()
    assert (near[np.arange(500), cluster] == d.min(axis=1)).all()


def test_displacement_is_of_the_whole_way():
    there_and_back = np.array([[[0, 0]], [[3, 4]], [[0, 0]]])
    assert C.displacements(there_and_back)[:, 0].tolist() == [0.0, 5.0, 0.0]  # summed drifts would give 10


def test_a_component_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="vector component"):
        got(spark, [(1, [1e9, 0.0, 0.0]), (2, [0.0, 0.0, 0.0])])


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{os.path.join(SF, 'embeddings.parquet')}')")
    want = con.sql(C.ORACLE)
    out = C.op11_centroid_clusters(spark, SF)
    assert sorted(out.columns) == sorted(want.columns)
    assert sorted(map(tuple, out.select(*want.columns).collect())) == sorted(want.fetchall())
