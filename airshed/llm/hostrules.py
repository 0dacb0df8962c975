"""Quality rules at document and host level, in column expressions only.

Each document gets its counts and two base rules: too few words, and too many words in
5-word windows that occur twice or more in the text. Three more rules are no fault of one
document but of a host that has many such: symbols beside words, a mean word length out of
the ordinary, copied lines. Failures of all five are then counted by host
(the source column; one row per host and task before the shuffle, so a hot host is no hot
key), and each host's failure rate is shrunk towards all hosts': with an empirical beta
prior of mean m and weight k (method of moments over the hosts' rates), the rate of a host
with f failures in n documents is (f + k m) / (n + k). A host whose rate exceeds LIMIT for
a rule is judged bad, and its documents are not kept; a small host needs more evidence.

The counts are written down once, as the host verdict needs all of them before any
document can be decided; the two numbers of each prior are all that reaches the driver.

A null text counts as empty (and fails by its number of words); a null source is no host
and gets no host verdict; rows that repeat count each time; null or repeated doc_ids are
reported as they are; very long texts are counted whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table, written

WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
LIMIT = 0.5
MOST_WEIGHT = 1e6  # of a prior, in documents, where hosts hardly differ
SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SYMBOL_PERCENT, LINE_PERCENT = 10, 30  # of the words; of the lines with a word
MEAN_LENGTH = (2, 12)  # characters of a word
BASE, RULES = ("few_words", "repeats"), ("few_words", "repeats", "symbols", "word_length", "copied_lines")


def let(value: Column, then) -> Column:
    """then(value), with the value computed once."""
    return F.transform(F.array(value), then)[0]


def words(text: Column) -> Column:
    plain = F.trim(F.translate(text, SPACES, " " * len(SPACES)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(window))))

    def covered(sorted_: Column) -> Column:
        def twice(s, j):
            same = [F.get(sorted_, j + d)["h"] == s["h"] for d in (-1, 1)]
            return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

        starts = F.sort_array(F.transform(F.filter(sorted_, twice), lambda s: s["i"]))
        begin = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
        step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"))
        return F.aggregate(starts, begin, step, lambda a: a["n"])

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, covered))

    return F.when(F.size(w) <= window, F.lit(0)).otherwise(let(hashes, count)).cast("long")


def lines(text: Column) -> Column:
    """n: lines with a word; dup: those of them that equal an earlier line."""
    with_word = F.filter(F.split(text, "\n", -1), lambda s: F.trim(F.translate(s, SPACES, " " * len(SPACES))) != "")
    return let(with_word, lambda s: F.struct(F.size(s).cast("long").alias("n"), (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("dup")))


def document_rules(docs: DataFrame) -> DataFrame:
    """doc_id, source, the counts and one boolean per rule (true: failed)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = docs.select("doc_id", F.col("source").cast("string").alias("source"), text.alias("text"))
    counts = out.select(
        "doc_id", "source",
        F.length(F.translate("text", " " + SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines(F.col("text")).alias("l"),
        let(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))).alias("w"),
    )
    counts = counts.select("doc_id", "source", "w.n_words", "word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), "w.n_repeat_words", F.col("l.n").alias("n_lines"))
    n, chars = F.col("n_words"), F.col("word_chars")
    return counts.withColumns({
        "few_words": n < LEAST_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * n,
        "symbols": (n > 0) & (100 * F.col("n_symbols") > SYMBOL_PERCENT * n),
        "word_length": (n > 0) & ((chars < MEAN_LENGTH[0] * n) | (chars > MEAN_LENGTH[1] * n)),
        "copied_lines": 100 * F.col("n_dup_lines") > LINE_PERCENT * F.col("n_lines"),
    }).drop("n_lines")


def host_verdicts(ruled: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(source, n, rate by rule, bad)."""
    failures = [F.count_if(F.col(r)).alias(f"f_{r}") for r in RULES]
    hosts = ruled.filter(F.col("source").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("n"), *failures)
    rate = {r: F.col(f"f_{r}") / F.col("n") for r in RULES}
    moments = hosts.agg(*(f(rate[r]).alias(f"{k}_{r}") for r in RULES for k, f in (("m", F.avg), ("v", F.var_pop)))).first()
    for r in RULES:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        weight = min(MOST_WEIGHT, max(1.0, m * (1 - m) / v - 1)) if v > 0 else MOST_WEIGHT
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"f_{r}") + weight * m) / (F.col("n") + weight))
    bad = F.greatest(*(F.col(f"rate_{r}") for r in RULES)) > limit
    return hosts.select("source", "n", *(f"rate_{r}" for r in RULES), bad.alias("bad"))


def judge(docs: DataFrame, limit: float = LIMIT) -> DataFrame:
    """One row per document: doc_id, source, counts, rules, base_failed, host_bad, kept."""
    ruled = written(document_rules(docs), "rules")
    hosted = ruled.filter(F.col("source").isNotNull()).join(host_verdicts(ruled, limit).select("source", F.col("bad").alias("host_bad")), "source")
    out = hosted.unionByName(ruled.filter(F.col("source").isNull()).withColumn("host_bad", F.lit(False)))  # no host, no join
    failed = F.col(BASE[0]) | F.col(BASE[1])
    return out.withColumns({"base_failed": failed, "kept": ~(failed | F.col("host_bad"))})


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)
), again AS (SELECT doc_id, s FROM win GROUP BY doc_id, s HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT win.doc_id, unnest(generate_series(i, i + 4)) AS j FROM win JOIN again USING (doc_id, s)) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n, count(*) AS every FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (
  SELECT d.doc_id, d.source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lines.every, 0) AS n_lines
  FROM d JOIN w USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)
), f AS (
  SELECT *, n_words < 10 AS few, 100 * n_repeat_words > 20 * n_words AS rpt, n_words > 0 AND 100 * n_symbols > 10 * n_words AS sym,
    n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words) AS len, 100 * n_dup_lines > 30 * n_lines AS dup FROM c
), h AS (
  SELECT source, rule, count(*) AS n, count(*) FILTER (failed) AS f FROM (
    SELECT source, unnest(['few', 'rpt', 'sym', 'len', 'dup']) AS rule, unnest([few, rpt, sym, len, dup]) AS failed FROM f WHERE source IS NOT NULL
  ) GROUP BY source, rule
), p AS (SELECT rule, avg(f / n) AS m, var_pop(f / n) AS v FROM h GROUP BY rule),
k AS (SELECT rule, m, CASE WHEN v > 0 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS w FROM p),
v AS (SELECT source, max((f + w * m) / (n + w)) > 0.5 AS bad FROM h JOIN k USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few OR rpt AS base_failed, NOT (few OR rpt OR coalesce(bad, false)) AS kept
FROM f LEFT JOIN v USING (source)
"""
