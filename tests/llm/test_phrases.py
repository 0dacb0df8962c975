import hashlib
import random

import pyarrow as pa

from airshed.llm import phrases as P

SCHEMA = "doc_id long, text string, seeds string, id string"


def brute(docs, window):
    first = {}
    split = [(1 << 62 if d is None else d, (t or "").encode().split()) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), kept.decode()))
    return out


def random_docs(seed, n=120):
    rng = random.Random(seed)
    some = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(some) for _ in range(rng.choice([13, 14, 30, 80]))] for _ in range(6)]
    docs = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(1, 5)):
            text += [rng.choice(some) for _ in range(rng.randrange(0, 40))]
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            text += p[a:] if rng.random() < 0.3 else p
        docs.append((i * 3 % 101 * 10 + i // 101, rng.choice([" ", "  ", "\n", "\t "]).join(text)))
    return docs + [(5000, "x " * 100), (5001, "x " * 50), (5002, "Ünï cödé " * 9), (5003, ""), (5004, None), (5005, "w1 w2")]


def test_cold_and_hot_seeds_equal_brute_force(spark, monkeypatch):
    docs = random_docs(4)
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], SCHEMA)
    want = dict(zip((d for d, _ in docs), brute(docs, 13)))
    assert any(n for _, n, _ in want.values())
    for hot, shard in ((10**9, 10), (3, 20), (0, 1000)):
        monkeypatch.setattr(P, "HOT", hot)
        monkeypatch.setattr(P, "SHARD", shard)
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in P.remove_repeated_phrases(df).collect()} == want


def test_null_ids_repeats_and_empty_table(spark):
    text = " ".join(f"a{i}" for i in range(20))
    docs = [(None, text), (4, text), (4, text), (4, "other " * 3), (9, "z " + text)]
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], SCHEMA)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in P.remove_repeated_phrases(df).collect())
    assert got == [("4", 3, 0), ("4", 20, 0), ("4", 20, 0), ("9", 21, 20), ("None", 20, 20)]
    assert P.remove_repeated_phrases(df.limit(0)).count() == 0
    assert hashlib.sha256(b"").hexdigest()


def test_two_letters_per_word_match_like_one(monkeypatch):
    segments = [b" ".join(f"w{(i * k) % 50}".encode() for i in range(20)) for k in range(1, 30)]
    table = pa.table({"seed": list(range(29)), "segment_hash": list(range(29)), "segment": pa.array(segments, pa.binary()), "id": list(range(100, 129))})
    one = P._locate(5)(table)
    numbers = P._letters

    def two(split):
        names = {}
        x = [[names.setdefault(w, len(names)) for w in s] for s in split]
        return ["".join(chr(0xE000 + n // 7) + chr(0xF000 + n % 7) for n in s) for s in x], 2

    monkeypatch.setattr(P, "_letters", two)
    assert P._locate(5)(table).equals(one)
    assert numbers([[b"a", b"b", b"a"]])[1] == 1
