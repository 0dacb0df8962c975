"""URL filter and quality rules, without Python on the executors."""

from collections import Counter

from airshed.llm import hostrules as H
from airshed.llm import urlfilter as U


def plan(df):
    return df._jdf.queryExecution().toString()


def test_rules_and_listed_urls(spark):
    pages = [
        (1, "https://a.example.org/es/x?q#f", "h"), (2, "http://EXAMPLE.org/en/12", "h"), (3, "http://notexample.org/es/", "h"), (4, "x://b.com/fr/", "h"), (5, "x://b.com/de/?a", "h"),
        (6, "http://m.b.net:80/p.html#t", "h"), (7, "https://www.b.net/p/", "h"), (8, "http://b.net/other", "h"), (9, None, "h"), (10, "no scheme", "h"), (10, "no scheme", "h"),
        (11, "http://example.com", "h"), (12, "://", "h"), (13, "http://b.net/" + "p" * 50_000, "h"), (14, "http://com/fr/", "h"), (None, "http://c.net?x://org/", "h"),
    ]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, rule string")
    listed = spark.createDataFrame([("b.net/p",), ("b.net/p",), (None,), ("z.org/",)], "canonical string")
    out = U.judge(df, listed)
    got = sorted((r.page_id or 0, r.host, r.path[:8], r.rule, r.verdict) for r in out.collect())
    assert got == sorted([
        (1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "example.org", "/en/12", "example.org/en/1", "block"), (3, "notexample.org", "/es/", "org/", "allow"),
        (4, "b.com", "/fr/", "com/fr/", "allow"), (5, "b.com", "/de/", "com/de/", "block"), (6, "m.b.net:80", "/p.html", None, "block"), (7, "www.b.net", "/p/", None, "block"),
        (8, "b.net", "/other", None, "allow"), (9, "", "", None, "allow"), (10, "", "", None, "allow"), (10, "", "", None, "allow"), (11, "example.com", "", None, "allow"),
        (12, "", "", None, "allow"), (13, "b.net", "/ppppppp", None, "allow"), (14, "com", "/fr/", "com/fr/", "allow"), (0, "c.net", "", None, "allow"),
    ], key=lambda x: (x[0], x[1], x[2]))
    assert U.judge(df.limit(0), listed).count() == 0 and {r.verdict for r in U.judge(df, listed.limit(0)).collect() if r.rule is None} == {"allow"}
    assert "Python" not in plan(out)


def test_a_tie_between_rules_blocks_and_only_possible_hits_are_shuffled(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 50}.net/p{i}") for i in range(2000)] + [(9000 + i, "http://often.net/x") for i in range(500)] + [(8000, "http://a.b.org/xy")], "page_id long, url string")
    tied = [("allow", "b.org", "/xy"), ("block", "a.b.org", "/"), ("block", "b.org", "/xy")]
    assert [r.verdict for r in U.judge(pages.filter("page_id = 8000"), pages.limit(0).selectExpr("url AS canonical"), tied).collect()] == ["block"]
    listed = spark.createDataFrame([("often.net/x",)], "canonical string")
    out = U.judge(pages, listed)
    assert {r.page_id for r in out.filter("verdict = 'block'").collect()} == set(range(9000, 9500))
    out.write.format("noop").mode("overwrite").save()
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "bits" in text and text.count("Join LeftOuter") >= 2


def test_the_filter_has_no_false_negatives_and_few_positives(spark):
    listed = spark.range(20_000).selectExpr("concat('h/', id) AS canonical")
    other = spark.range(20_000).selectExpr("concat('o/', id) AS canonical")
    from pyspark.sql import functions as F

    key = F.col("canonical")
    for df, low, high in ((listed, 20_000, 20_000), (other, 0, 40)):
        hits = df.join(U.bloom(listed), U._word(key) == F.col("word")).filter(U._mask(key).bitwiseAND(F.col("bits")) == U._mask(key))
        assert low <= hits.count() <= high


def counts(text):
    w = (text or "").encode().split()
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_and_host_verdicts(spark):
    texts = [None, "", "  \t\n", "a b c d e", "a b c d e a b c d e", "x " * 300, "one two\nthree\n\none two\n \n one two", "été ## $% <b> nbsp " * 3, "\x0bq\x0cr\rs", "a b c d e f " * 2 + "g h", " ".join(str(i) for i in range(5000))]
    docs = [(i, t, None, "clash") for i, t in enumerate(texts)]
    docs += [(100 + i, "too short", "bad", "c") for i in range(40)] + [(200, " ".join(map(str, range(20))), "bad", "c"), (None, " ".join(map(str, range(20))), None, "c")]
    for h in range(12):
        docs += [(1000 + h * 50 + i, " ".join(f"{h}{i}{j}" for j in range(12)) if i else "short", f"h{h}", "c") for i in range(20)]
    out = H.judge(spark.createDataFrame(docs, "doc_id long, text string, source string, kept string"))
    rows = {r.doc_id: r for r in out.collect()}
    for i, t, s, _ in docs:
        r, want = rows[i], counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r.base_failed == failed and r.kept == (not failed and s != "bad")
    assert rows[200].host_bad and not rows[None].host_bad
    good = [" ".join(f"w{i}{j}" for j in range(15)) for i in range(60)]
    junk = {"symbols": " ".join(["word#"] * 3 + [f"$a{j}" for j in range(12)]), "word_length": " ".join(f"{j}" * 14 for j in range(12)), "copied_lines": "\n".join(["stop"] * 4 + [f"line {j} of text a{j} b{j}" for j in range(5)])}
    docs = [(k * 100 + i, junk[r] if i % 10 else good[i], r, "c") for k, r in enumerate(junk) for i in range(40)]
    docs += [(1000 + h * 50 + i, good[i + h], f"h{h}", "c") for h in range(20) for i in range(20)]
    rows = {r.doc_id: r for r in H.judge(spark.createDataFrame(docs, "doc_id long, text string, source string, kept string")).collect()}
    for i, _, s, _ in docs:  # a host full of junk loses all its documents, though none fails by itself
        assert not rows[i].base_failed and rows[i].kept == s.startswith("h"), (i, s)
    assert H.judge(out.select("doc_id", "source", "kept").limit(0).selectExpr("*", "'a' AS text")).count() == 0
    assert "Python" not in plan(out)
