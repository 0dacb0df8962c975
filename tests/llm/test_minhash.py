import random
import re

import numpy as np

from airshed.llm import minhash as M

SCHEMA = "doc_id long, text string, n_shingles string, kept long"


def brute(docs, percent=85):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        best[r] = min(best.get(r, 1 << 62), 1 << 62 if d is None else d)
    return sorted(((d is None, d or 0), len(sets[i]), best[find(i)] if best[find(i)] < 1 << 62 else None) for i, (d, _) in enumerate(docs))


def got(spark, docs):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA)
    return sorted(((r.doc_id is None, r.doc_id or 0), r.n_shingles, r.component_id) for r in M.near_duplicates(df).collect())


def test_group_of_near_copies_with_chains(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    docs = []
    for i in range(140):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 8, 20])):
            own[rng.randrange(150)] = rng.choice(vocabulary)
        docs.append((1000 - i, " ".join(own)))
    chain = [rng.choice(vocabulary) for _ in range(200)]
    for i in range(25):  # each near the last, the ends far apart
        chain = list(chain)
        chain[(i * 8) % 200] = f"c{i}"
        docs.append((2000 + i, " ".join(chain)))
    docs += [(3000 + i, " ".join(rng.choice(vocabulary) for _ in range(60))) for i in range(40)]
    assert got(spark, docs) == brute(docs)


def test_full_buckets_meet_in_blocks(spark, monkeypatch):
    """Many texts of one template, few of them similar: buckets stay open to the last step."""
    monkeypatch.setattr(M, "BLOCK", 4)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(160)]
    docs = []
    for i in range(90):
        own = list(base)
        for at in rng.sample(range(8, 150, 12), rng.choice([2, 3, 4])):
            own[at] = rng.choice(["x", "y"])
        docs.append((i, " ".join(own)))
    assert got(spark, docs) == brute(docs)


def test_edges_nulls_and_repeats(spark):
    docs = [(1, "A b C"), (2, "a b c"), (3, "a b"), (4, ""), (5, None), (6, " \t\n"), (7, "x"), (7, "x"), (7, "y z"), (8, " nbsp stays a word"), (9, "É é"), (10, "é é")]
    assert got(spark, docs) == brute(docs)
    assert got(spark, [(None, "same words in here please"), (5, "same words in here please"), (None, "")]) == [((False, 5), 1, 5), ((True, 0), 0, None), ((True, 0), 1, 5)]
    assert got(spark, []) == []


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(1)
    both = rng.integers(1, 1 << 63, 300, dtype=np.uint64)
    a, b = np.concatenate([both, rng.integers(1, 1 << 63, 50, dtype=np.uint64)]), np.concatenate([both, rng.integers(1, 1 << 63, 50, dtype=np.uint64)])
    s = M.signatures(np.array([0, 350, 700]), np.concatenate([a, b]), 2000)
    assert abs((s[:, 0] == s[:, 1]).mean() - 0.75) < 0.04


def test_bands_bound_the_misses():
    for percent in (70, 80, 85, 90, 95):
        n = M.bands(percent)
        assert (1 - (percent / 100) ** M.ROWS) ** n <= M.MISS < (1 - (percent / 100) ** M.ROWS) ** (n - 1)
    assert M.bands(85) == 25


def between_80_and_85(n=60):
    """Pairs of texts whose similarity is from 0.80 to below 0.85."""
    rng = random.Random(8)
    docs = []
    while len(docs) < 2 * n:
        own = [f"w{rng.randrange(10**6)}" for _ in range(124)]
        other = list(own)
        for i in rng.sample(range(10, 110, 12), 2):
            other[i] = f"c{rng.randrange(10**6)}"
        other += [f"t{rng.randrange(10**6)}" for _ in range(rng.choice([3, 6]))]
        docs += [(len(docs), " ".join(own)), (len(docs) + 1, " ".join(other))]
    return docs


def test_at_80(spark):
    docs = between_80_and_85()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA)
    at_80 = brute(docs, 80)
    assert len({c for _, _, c in at_80}) < len({c for _, _, c in brute(docs)}) == len(docs)
    assert sorted(((False, r.doc_id), r.n_shingles, r.component_id) for r in M.near_duplicates(df, 80).collect()) == at_80
