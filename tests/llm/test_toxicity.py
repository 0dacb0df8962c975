import random
import zlib

from airshed.llm import toxicity as X

DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    rows = X.op6_toxicity(spark, DIR).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p for y, p in held if y) >= 0.9 * sum(y for y, _ in held)  # recall
    assert sum(p for y, p in held if not y) <= 0.01 * len(held)  # of others rejected
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    for own in ("en", "de", "fr", "es"):  # every language has a threshold of its own
        found = [r.predicted for r in rows if r.held_out and labels.get(r.doc_id) and lang[r.doc_id] == own]
        assert sum(found) >= 0.75 * len(found), own


def test_scores_need_the_text_alone_and_odd_rows(spark):
    good, bad = "the cat sat on the mat and was happy", "stupid moron"
    rng = random.Random(2)

    def some(words, n=12):
        return " ".join(rng.choice(words.split()) + " " + rng.choice("abcdefghijk") * rng.randrange(1, 5) for _ in range(n))

    texts = [(i, some(good)) for i in range(60)] + [(100 + i, some(good) + " " + some(bad, 3)) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100), None) for i, _ in texts] + [(1, 0, 3), (5, None, 1), (6, 7, 0)], "doc_id long, toxic int, quality int")
    model = X.fit(docs, labels)
    odd = spark.createDataFrame([(None, bad, "en", 0.0), (1, bad, "fr", 0.0), (1, bad, "fr", 0.0), (2, None, None, 0.0), (3, "", "de", 0.0), (4, good * 500, "en", 0.0), (4, "!!!", "en", 0.0)], "doc_id long, text string, lang string, score double")
    rows = X.score(odd, model).collect()
    assert len(rows) == 7 and len({r.score for r in rows if r.text == bad}) == 1
    assert all((r.score >= 0.7) == (r.text == bad) for r in rows)
    assert X.score(odd.limit(0), model).count() == 0
    assert X.fit(docs, labels.limit(0)) is None and {r.score for r in X.score(odd, None).collect()} == {0.0}


def plain_score(model, text):
    """The network with loops over words, filters and widths."""
    import math
    import re

    import numpy as np
    import pyarrow as pa

    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hashes = [next(X._hashed(pa.array([w])))[2][0] for w in found]
    prints = model.prints.tolist()
    place = {h: i for i, h in enumerate(prints)}
    own = [place.get(int(h), len(prints)) for h in hashes]
    logit = 0.0
    for net in model.networks:
        pooled = []
        for width, filters, bias in zip(X.WIDTHS, net.filters, net.bias):
            for f in range(X.FILTERS):
                best = -math.inf
                for at in range(max(len(own), 1)):
                    words = [own[at + j] if at + j < len(own) else len(prints) for j in range(width)]
                    best = max(best, sum(float(np.dot(net.embeddings[w].astype(float), filters[j][:, f].astype(float))) for j, w in enumerate(words)))
                pooled.append(max(best + float(bias[f]), 0.0))
        logit += (sum(p * float(w) for p, w in zip(pooled, net.weights)) + net.offset) / len(model.networks)
    count = [sum(h in set(X._hashed(pa.array([t])).__next__()[2].tolist()) for h in map(int, hashes)) for t in X.FUNCTION_WORDS.values()]
    language = count.index(max(count)) if max(count) else len(count)
    return 1 / (1 + math.exp(-(logit - model.shifts[language] + math.log(X.CUT / (1 - X.CUT)))))


def test_scores_equal_plain_loops_however_the_rows_are_dealt(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text for r in rows]
    model = X.train(texts, [int("the" in (t or "").split()) for t in texts])
    odd = [(-1, None), (-2, ""), (-3, "a"), (-4, "A b"), (-5, "..."), (-6, "der die das"), *[(r.doc_id, r.text) for r in rows if len(r.text or '') < 1500][:12]]
    for parts in (1, 5):
        df = spark.createDataFrame(odd, "doc_id long, text string").repartition(parts)
        got = {r.doc_id: r.score for r in X.score(df, model).collect()}
        for doc_id, text in odd:
            assert abs(got[doc_id] - plain_score(model, text)) < 1e-4, doc_id
    labels = spark.createDataFrame([(r.doc_id, int("the" in (r.text or "").split())) for r in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    a, b = X.fit(docs.repartition(7), labels.repartition(3)), X.fit(docs.coalesce(1), labels)
    assert (a.prints == b.prints).all() and all((m.embeddings == n.embeddings).all() for m, n in zip(a.networks, b.networks)) and (a.shifts == b.shifts).all()


def test_every_labelled_text_counts(spark, monkeypatch):
    """Words in three of 4,200 texts all have an embedding, whichever parts train them; a sample of 4,000 texts would miss some."""
    monkeypatch.setattr(X, "PART", 700)
    rows = [(3 * i, f"w{i // 3} u{i}a u{i}b u{i}c " + ("awful" if i % 8 == 0 else "fine"), int(i % 8 == 0)) for i in range(4200 * 2)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    times = {}
    for _, text, _ in rows:
        for w in set(text.split()):
            times[w] = times.get(w, 0) + 1
    import pyarrow as pa

    model = X.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    found = set(model.prints.tolist())
    own = [w for w, n in times.items() if n >= X.LEAST_TEXTS]
    held = sum(int(next(X._hashed(pa.array([w])))[2][0]) in found for w in own)
    assert len(rows) > 5000 and held >= 0.995 * len(own) and len(found) <= len(own)  # two words may share a bucket
    got = {r.text: r.score for r in X.score(spark.createDataFrame([(1, "u1a awful"), (2, "u2a fine")], "doc_id long, text string"), model).collect()}
    assert got["u1a awful"] >= X.CUT > got["u2a fine"]


def test_long_texts_are_learnt_from(spark):
    rng = random.Random(5)
    rows = [(i, f"{'vile' if i % 2 else 'kind'} " + " ".join(f"word{rng.randrange(4000)}" for _ in range(3000)), i % 2) for i in range(60)]
    assert min(len(t) for _, t, _ in rows) > 20_000
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert X.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic")) is not None
