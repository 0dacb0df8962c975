"""Hard negatives against plain inner products over all rows."""

import math

import duckdb
import numpy as np
import pytest

from airshed.llm import negatives as N

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, label int, embedding array<float>, rank string, score int"


def brute(rows, every=3, positives=5, negatives=10):
    kept = []
    for i, label, v in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    last = lambda i: (i is None, i or 0)
    out, mined = [], set()
    for i, label, v in kept:
        if i is None or i % every or (i, label, tuple(v)) in mined:
            continue
        mined.add((i, label, tuple(v)))
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), last(j), j, l) for j, l, w in kept if j != i), key=lambda x: x[:2])
        for p in [x for x in scored if x[3] == label][:positives]:
            ps = -p[0]
            fit = [x for x in scored if x[3] != label and 30 * ps <= -100 * x[0] <= 90 * ps]
            out += [(i, p[2], r, x[2], ps, -x[0]) for r, x in enumerate(fit[:negatives], 1)]
    return sorted(out, key=repr)


def got(spark, rows, every=3, **more):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    return sorted(map(tuple, N.mine(df, df.filter(f"vec_id % {every} = 0"), **more).collect()), key=repr)


@pytest.mark.parametrize("block,anchors", [(4096, 128), (7, 4)])
def test_equals_plain_products(spark, monkeypatch, block, anchors):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "ANCHORS", anchors)
    rng = np.random.default_rng(block)
    rows = [(i, int(rng.integers(3)), rng.normal(size=11).astype(np.float32).tolist()) for i in range(90)]
    found = got(spark, rows)
    assert found == brute(rows) and len(found) > 200


def test_ties_repeats_nulls_and_short_vectors(spark):
    nan = float("nan")
    rows = [(i, i % 2, [1.0, float(i % 3), 0.5]) for i in range(40)]  # many equal scores
    rows += [(3, 1, [1.0, 0.0, 0.5]), (3, 0, [0.5, 0.25, 0.25]), (6, 0, [1.0, 0.0, 0.5])]  # repeated ids, one of them exactly
    rows += [(None, 1, [0.75, 1.0, 0.5]), (None, 0, [2.0, 2.0, 0.5]), (41, 0, None), (42, None, [1.0, 1.0, 1.0]), (43, 1, [1.0, nan, 1.0]), (44, 1, [1.0, None, 1.0]), (45, 0, [float("inf"), 0.0, 0.0])]
    rows += [(46, 1, [0.75]), (48, 0, []), (-9, 1, [-1.0, -2.0, 0.25]), (51, 1, [0.0, 0.0, 0.0]), (60, 9, [1.0, 1.0, 1.0])]
    assert got(spark, rows) == brute(rows)
    hot = [(i, 0 if i else 1, [0.5, 0.5]) for i in range(300)] + [(301, 1, [1.0, 1.0])]  # one vector for nearly all
    assert got(spark, hot, 50) == brute(hot, 50)


def test_empty_tables_and_errors(spark):
    assert got(spark, []) == [] and got(spark, [(3, None, [1.0])]) == [] and got(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []
    with pytest.raises(Exception, match="vector component"):
        got(spark, [(3, 1, [1e9]), (4, 1, [0.0])])


def test_scores_are_exact():
    rng = np.random.default_rng(2)
    for width, most in ((1, 3), (8, 150), (13, 1 << 20), (64, 150), (64, 1 << 19)):
        a, b = rng.integers(-most, most + 1, (33, width)), rng.integers(-most, most + 1, (100, width))
        b[0], b[1] = -most, most
        assert (N.scores(N.planes_of(b), a, step=32) == b @ a.T).all()
    assert (N.scores(N.planes_of(np.zeros((3, 0), np.int64)), np.zeros((2, 4), np.int64)) == 0).all()


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.sql(N.ORACLE)
    out = N.op13_hard_negatives(spark, SF)
    assert sorted(out.columns) == sorted(want.columns)
    rows = sorted(map(tuple, out.select(*want.columns).collect()))
    assert rows == sorted(want.fetchall()) and rows
