"""URL filter: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

Rules first: a rule fits a URL whose host is the rule's or a subdomain of it and whose path
starts with the rule's; the longest rule wins (host and path together; block wins a tie).
URLs without a rule are looked up in a list of canonical URLs. A blocked Bloom filter of
the list (one 64-bit word per URL, BITS bits in it) is built by an aggregate: one row per
word, bits joined with OR, at most WORDS rows whatever the list's size. URLs that may be
listed go on to an exact join on the canonical URL, which removes the false positives;
both joins are hash or merge joins that Spark sizes itself. On a list far larger than the
filter more URLs take the exact join; the result is the same.

Everything is column expressions. Canonical: scheme, "www." and "m.", port 80 and 443,
fragment, query, a closing "/" and ".html" dropped, host lower-cased.

A null url, or one without "://", has an empty host and path, fits no rule and is allowed; a
null or empty list blocks nothing; repeated list entries count once; rows that repeat are
judged alike; very long URLs are judged whole; an empty table gives an empty result; other
columns pass through untouched or, where they clash with host, path, rule or verdict, are
replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table, written

# fixed values: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
WORDS, BITS = 1 << 18, 5  # 2 MB of filter; a row of it is two longs
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host_: Column, path_: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(host_, r"^(www|m)\.", ""), r":(80|443)$", "")
    return F.concat(bare, F.regexp_replace(path_, r"(?s)(\.html|/)$", ""))


def rule_of(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls for none."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1]))

    def fits(name, prefix):
        return ((host_ == name) | F.endswith(host_, F.lit("." + name))) & F.startswith(path_, F.lit(prefix))

    tests = [(fits(h, p), h + p, v) for v, h, p in longest]

    def choose(k):
        none = F.lit(None).cast("string")
        return reduce(lambda rest, t: F.when(t[0], F.lit(t[k])).otherwise(rest), reversed(tests), none)

    return choose(1), choose(2)


def _word(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(WORDS))


def _mask(key: Column) -> Column:
    """BITS bits of a 64-bit word."""
    h = F.xxhash64(key, F.lit("bits"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def bloom(listed: DataFrame) -> DataFrame:
    """(word, bits): the blocked filter of the list's `canonical` column; at most WORDS rows."""
    return listed.groupBy(_word(F.col("canonical")).alias("word")).agg(F.bit_or(_mask(F.col("canonical"))).alias("bits"))


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """The input's columns, host, path, rule and verdict. `listed` has canonical URLs to block."""
    columns = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    url = F.col("url").cast("string")
    out = pages.select(F.struct(*columns).alias("page"), host(url).alias("host"), path(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    key = F.when(rule.isNull() & (F.col("host") != ""), canonical(F.col("host"), F.col("path")))
    out = out.select("page", "host", "path", rule.alias("rule"), verdict.alias("ruled"), key.alias("canonical"))
    listed = written(listed.select("canonical").filter(F.col("canonical").isNotNull()).distinct(), "listed")
    # pages that a rule decides, or that have no host, ask nothing
    settled = out.filter(F.col("canonical").isNull()).select("page", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"))
    asked = out.filter(F.col("canonical").isNotNull()).select("page", "host", "path", "rule", "canonical")
    key = F.col("canonical")
    asked = asked.join(F.broadcast(bloom(listed)), _word(key) == F.col("word"), "left")  # at most WORDS rows
    possible = F.coalesce(_mask(key).bitwiseAND(F.col("bits")) == _mask(key), F.lit(False))
    passed = asked.filter(~possible).select("page", "host", "path", "rule", F.lit("allow").alias("verdict"))
    exact = asked.filter(possible).select("page", "host", "path", "rule", "canonical").join(listed.withColumn("hit", F.lit(True)), "canonical", "left")
    exact = exact.select("page", "host", "path", "rule", F.when(F.col("hit"), "block").otherwise("allow").alias("verdict"))
    return settled.union(passed).union(exact).select("page.*", "host", "path", "rule", "verdict")


def held_twice(pages: DataFrame) -> DataFrame:
    """Canonical URLs under which the crawl holds more than one page."""
    url = F.col("url").cast("string")
    own = pages.select(canonical(host(url), path(url)).alias("canonical"), host(url).alias("host")).filter("host != ''")
    return own.groupBy("canonical").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("canonical")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed: canonical URLs that the crawl holds under several pages."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, held_twice(pages)).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), r(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), m AS (
  SELECT u.page_id, u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS ruled
  FROM u LEFT JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY ALL
), k AS (
  SELECT *, regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '') || regexp_replace(path, '(?s)(\.html|/)$', '') AS canonical FROM m
), d AS (SELECT canonical FROM k WHERE host <> '' GROUP BY canonical HAVING count(*) > 1)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN host <> '' AND canonical IN (SELECT canonical FROM d) THEN 'block' ELSE 'allow' END) AS verdict FROM k
"""
