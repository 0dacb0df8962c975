import hashlib
import re

from airshed.llm import decontaminate as D

SCHEMA = "doc_id long, text string, items string, spans long"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(texts, items, window=13):
    windows = {}
    for name, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(name))
    out = []
    for t in texts:
        w = words(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[x]
        out.append((len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_windows_short_items_and_shards(spark):
    import random

    rng = random.Random(8)
    vocabulary = "a b c d e é ß 1 22".split()
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 6, 20])))) for i in range(4, 30)]
    items = [x for x in items if len(x[1].split()) != 1] + [(100, "zz"), (101, "ZZ!"), (102, ""), (103, None), (104, "...")]
    texts = [" ".join(rng.choice(vocabulary + ["q"] * 2) for _ in range(rng.choice([0, 3, 40, 200]))) for _ in range(60)]
    texts += [f"q q {t} q" for _, t in items if t] + [None, "", "zz", "Zz,zz", "!?"]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items, 6)
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in D.decontaminate(docs, bench, window=6).collect()}
    assert got == dict(enumerate(want))
    for size in (40, 24):  # several shards; items of 20 words in overlapping parts
        found = D.find_contamination(docs, bench, 6, size).collect()
        assert {r.id: (r.n_words, sum(s["hi"] - s["lo"] for s in r.spans), list(r["items"])) for r in found} == {i: w[:3] for i, w in enumerate(want)}


def test_a_long_item_is_cut_and_a_passage_in_many_items_is_held_once(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(500))
    shared = " ".join(f"s{i}" for i in range(30))
    items = [(1, long), (None, long)] + [(i, f"a{i} {shared} b{i}") for i in range(10, 60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [long, " ".join(long.split()[90:110]), "q " + shared, shared + " b17", "w1 w2 w3"]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    want = [(n, h, [x for x in names if x != "None"]) for n, h, names, _ in brute(texts, items)]
    paths = D.compiled_items(bench, str(tmp_path / "automata"), shard_words=200)
    assert len(paths) > 5
    parts = [D._load(p) for p in paths]
    assert max(len(known) for known, _, _ in parts) <= 400
    assert sum(len(a.laid) for _, a, _ in parts) <= 2 * sum(len(t.split()) for _, t in items)
    for size in (200, D.SHARD_WORDS):
        found = D.find_contamination(docs, bench, shard_words=size).collect()
        assert {r.id: (r.n_words, sum(s["hi"] - s["lo"] for s in r.spans), list(r["items"])) for r in found} == dict(enumerate(want))


def test_spans_are_cut_and_odd_tables(spark):
    item = " ".join(f"w{i}" for i in range(15))
    docs = spark.createDataFrame([(1, "X, " * 600 + item + "! y", "x", 1), (2, item, "x", 1), (None, "x " + item, "x", 1), (3, "clean", "x", 1), (3, "clean", "x", 1)], SCHEMA)
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    rows = D.without_contamination(docs, bench).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [(1, "X, " * 600 + "! y"), (3, "clean"), (3, "clean")]
    assert {(r["items"], r.spans) for r in rows} == {("x", 1)}  # the input's own columns
    assert D.without_contamination(docs.limit(0), bench).count() == 0 and D.without_contamination(docs, bench.limit(0)).count() == 5
    assert D.decontaminate(docs.limit(0), bench).count() == 0
    none = D.decontaminate(docs, bench.limit(0)).collect()
    assert len(none) == 5 and not any(r.contaminated or r.n_hit for r in none)
    assert hashlib.sha256(b"").hexdigest()
