import corpus_pipeline as P
from airshed.llm import pieces, toxicity
from test_decontaminate import brute as contaminated
from test_minhash import brute as components
from test_pieces import library

DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, ids long"


def without_windows(text, items, window=13):
    """The text without the words of any window of an item, and what lies between them."""
    import re

    def fold(t):
        return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")

    def words(t):
        return [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))]

    def folded(t, spans):
        return [fold(t)[a:b] for a, b in spans]

    windows = set()
    for _, t in items:
        w = folded(t, words(t))
        n = min(window, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1 if n else 0)}
    places = words(text)
    own, hit = folded(text, places), set()
    for n in {len(x) for x in windows}:
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit |= set(range(i, i + n))
    out, at = "", 0
    for i in sorted(hit):
        if i - 1 not in hit:
            out += text[at : places[i][0]]
        at = places[i][1]
    return text if not hit else out + text[at:]


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    score = {r.doc_id: r.predicted for r in toxicity.op6_toxicity(spark, DIR).collect()}
    left = [i for i in sorted(rows) if not score[i]]
    kept = {i for (_, i), _, c in components([(i, rows[i].text) for i in left], 80) if c == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    left = [i for i in left if i in kept]
    left = [i for i, bad in zip(left, contaminated([rows[i].text for i in left], items)) if not bad[-1]]
    from airshed.llm import pseudonyms as X

    cut = spark.createDataFrame([(i, without_windows(rows[i].text, items)) for i in left], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in X.pseudonymise(cut).collect()}
    want = dict(zip(left, library([texts[i] for i in left])))
    got = {r.doc_id: r for r in P.run(spark, DIR).collect()}
    assert {i: r.ids for i, r in got.items()} == want
    assert all(r.round_trip and r.text == texts[i] and r.n_chars == len(r.text) and (r.lang, r.source) == (rows[i].lang, rows[i].source) for i, r in got.items())
    assert 0 < len(got) < len(rows) and any(r.text != rows[i].text for i, r in got.items())


def test_odd_rows_and_clashing_columns_pass_every_stage(spark):
    good = "one two three four five six seven eight nine ten"
    data = [(None, None, None, None, None, "s", 1), (1, "", "en", None, 0, "s", 2), (1, "", "en", None, 0, "s", 2), (2, good, "en", "x", 9, "s", 3), (2, good, "en", "x", 9, "s", 3), (None, good, "en", "x", 9, "s", 4), (3, good * 300, "en", "x", 9, "t", 5)]
    docs = spark.createDataFrame(data, SCHEMA)
    for (name, stage), columns in zip(P.STAGES, [SCHEMA.replace(" long", "").replace(" string", "").split(", ")] * 4 + [["doc_id", "text", "lang", "source", "n_chars", "score", "ids", "round_trip"]]):
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == columns or name == "sentencepiece" and sorted(out.columns) == sorted(columns)
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
        got = sorted((r.doc_id or 0, r.text or "", r.score) for r in out.collect())
        if name == "minhash_near_dedup":
            assert got == sorted([(0, "", "s"), (1, "", "s"), (1, "", "s"), (2, good, "s"), (3, good * 300, "t")])
        else:
            assert got == sorted((d or 0, t or "", s) for d, t, _, _, _, s, _ in data)
    assert pieces.MODEL
