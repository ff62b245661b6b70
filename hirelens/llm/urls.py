"""Operator 8, URL filters: list rules first, then association rules mined by FP-growth.

* List rules (host, path) fit their host and its subdomains if the url's path starts with the
  rule's path; the longest host + path wins, then the longer host, then the smaller text.
* What no list rule fits is judged by mined rules.  A labelled url (by default: one that a list
  rule judges; or any table of url and verdict) is a transaction of tokens -- scheme, top-level
  domain, host labels, path parts with digits masked, query names, file ending, fragment, all of the
  whole url -- and its verdict.  Tokens below the minimal support can be in no rule and are left out first, and
  of tokens that stand in the same urls one is kept; both change no rule's counts.  FP-growth finds the frequent sets; rules ``tokens -> block`` of at most
  ``MAX_TOKENS`` tokens stay if support and confidence reach the minima and no shorter rule
  within them has the same or higher confidence.
* Matching is by an inverted index: each rule is filed under its rarest token; the distinct token
  sets of the urls meet the rules of their tokens, and a rule fits if all its tokens are there.

The labelled urls for the mining are a hash sample of at most about ``MAX_LABELLED``; everything
else covers all rows.  Distinct token sets are judged once, so hot hosts are not expanded.

Defined results: a null url or one without ``://`` has an empty host and path, fits no list rule
and has no tokens, so it is allowed; a url without a path does not start with a rule's ``/``; a
port or user name counts as part of the host; no labelled url of a kind, or no rule: allow;
repeated rows and null ids are rows like any other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import Scratch, join_keyed, ready, table

#: The contract's rules: (verdict, host, path).
LIST_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
MAX_TOKENS = 3
MAX_LABELLED = 200_000
BLOCKED = "=block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of the whole url; empty without ``://``."""
    def mask(c: Column) -> Column:
        return F.regexp_replace(F.translate(c, UPPER, LOWER), "[0-9]+", "0")

    labels = F.split(host, r"\.")
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1)), lambda p: p != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z]{1,5})$", 1)
    some = lambda c, head: F.when(c != "", F.array(F.concat(F.lit(head), c))).otherwise(F.array().cast("array<string>"))
    found = F.concat(
        some(F.substring_index(host, ".", -1), "tld:"),
        F.transform(parts, lambda p, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), mask(p))),
        F.transform(F.filter(labels, lambda x: x != ""), lambda x: F.concat(F.lit("host:"), mask(x))),
        some(F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1)), "scheme:"),
        F.transform(names, lambda p: F.concat(F.lit("query:"), mask(p))),
        some(F.lower(ending), "ending:"),
        F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")))
    empty = F.array().cast("array<string>")
    return F.when(url.contains("://"), F.sort_array(F.array_distinct(found))).otherwise(empty)


def with_list_verdict(pages: DataFrame, rules=None) -> DataFrame:
    """``pages`` (url, host, path, ...; written) with ``rule`` and ``listed`` (null where none fits).

    Each distinct host is matched to the rules of its suffixes by a join; the rules of one host
    are few, and their paths are tested in the row.  Frequent hosts get theirs by broadcast.
    """
    spark = pages.sparkSession
    rules = LIST_RULES if rules is None else rules
    r = spark.createDataFrame([(v, h.lower(), p, h + p) for v, h, p in rules], "verdict string, r_host string, r_path string, rule string")
    hosts = pages.select("host").distinct().filter("host != ''")
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    suffixes = hosts.select("host", F.explode(F.array_distinct(tails)).alias("r_host"))
    by_host = (suffixes.join(r, "r_host").groupBy("host")
               .agg(F.sort_array(F.collect_set(F.struct(-F.length("rule"), -F.length("r_host"), "rule", "verdict", "r_path"))).alias("fits")))
    every = pages.groupBy("host").agg(F.count("*").alias("n")).join(by_host, "host", "left")
    best = F.get(F.filter("fits", lambda x: F.startswith(F.col("path"), x["r_path"])), F.lit(0))
    every = Scratch(spark, "hosts").write(every, "hosts")
    return (join_keyed(pages, every, ["host"], "n").withColumn("best", best)
            .withColumn("rule", F.col("best.rule")).withColumn("listed", F.col("best.verdict")).drop("fits", "best", "n"))


def frequent_tokens(sample: DataFrame, min_support: float) -> Column:
    """The tokens that can be in a rule: those of ``min_support`` urls or more (exact: no set is more frequent than its
    members); of tokens that stand in the very same urls the first one speaks for all, since sets of them
    say the same."""
    n = sample.count()
    each = sample.select(F.explode("tokens").alias("token"), F.xxhash64("sample_key", "tokens").alias("u"))
    each = each.groupBy("token").agg(F.count("*").alias("c"), F.sum(F.col("u").cast("decimal(38,0)")).alias("x"),
                                     F.sum(F.xxhash64("u").cast("decimal(38,0)")).alias("y"))
    kept = each.filter(F.col("c") >= min_support * n).groupBy("c", "x", "y").agg(F.min("token").alias("token"))
    tokens = sorted(r.token for r in kept.select("token").collect())  # at most the tokens of a url / min_support
    return F.filter("tokens", lambda t: t.isin(tokens)) if tokens else F.array().cast("array<string>")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(tokens, confidence, support) of rules ``tokens -> block`` from (tokens, verdict)."""
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "tokens array<string>, confidence double, support double")
    counts = {r.verdict: r.n for r in labelled.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if not counts.get("block"):
        return empty
    sample = labelled.filter(F.pmod(F.xxhash64("sample_key"), F.lit(1 << 30)) < int(min(1.0, MAX_LABELLED / total) * (1 << 30)))
    sample = sample.withColumn("tokens", frequent_tokens(sample, min_support))
    baskets = sample.select(F.when(F.col("verdict") == "block", F.concat("tokens", F.array(F.lit(BLOCKED))))
                            .otherwise(F.col("tokens")).alias("items"))
    sets = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets).freqItemsets
    sets = sets.filter(F.size("items") <= MAX_TOKENS + 1).withColumn("key", F.sort_array("items"))
    n = sample.count()
    whole = sets.filter(F.array_contains("items", BLOCKED) & (F.size("items") > 1)).select(
        F.sort_array(F.array_remove("items", BLOCKED)).alias("key"), F.col("freq").alias("hits"))
    rules = (sets.join(whole, "key").filter(F.size("key") <= MAX_TOKENS)
             .select(F.col("key").alias("tokens"), (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / F.lit(n)).alias("support"))
             .filter((F.col("confidence") >= min_confidence) & (F.col("support") >= min_support)))
    # prune: a rule within which a shorter one is at least as sure (found by its sub-sets' keys)
    subsets = rules.select(F.col("tokens").alias("long"), F.col("confidence").alias("sure"),
                           F.explode(F.concat(F.transform("tokens", lambda t: F.array(t)),
                                              F.transform("tokens", lambda t: F.array_remove("tokens", t)))).alias("tokens"))
    worse = (subsets.filter(F.size("tokens") < F.size("long")).join(rules, "tokens")
             .filter(F.col("confidence") >= F.col("sure")).select(F.col("long").alias("tokens")).distinct())
    return rules.join(worse, "tokens", "left_anti")


def judge(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(set_key, mined_rule, confidence) of the surest rule that fits each of (set_key, tokens)."""
    own = sets.select("set_key", "tokens", F.explode("tokens").alias("token"))
    often = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    filed = (rules.withColumn("rule_id", F.array_join("tokens", " ")).select("rule_id", F.col("tokens").alias("needs"), "confidence", F.explode("tokens").alias("token"))
             .join(often, "token").groupBy("rule_id")
             .agg(F.first("needs").alias("needs"), F.first("confidence").alias("confidence"), F.min_by("token", F.struct("n", "token")).alias("token")))
    hits = own.join(filed, "token").filter(F.size(F.array_except("needs", "tokens")) == 0)
    return (hits.groupBy("set_key").agg(F.max_by("rule_id", F.struct("confidence", "rule_id")).alias("mined_rule"),
                                        F.max("confidence").alias("confidence")))


def filter_urls(pages: DataFrame, rules=None, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule, verdict, mined_rule, confidence for each row of ``pages``."""
    spark = pages.sparkSession
    ready(spark)
    scratch = Scratch(spark, "urls")
    url = F.col("url")

    def parsed(df: DataFrame) -> DataFrame:
        d = df.withColumn("host", host_of(url)).withColumn("path", path_of(url))
        return d.withColumn("tokens", tokens_of(url, F.col("host"), F.col("path")))

    base = scratch.write(parsed(pages.select("page_id", "url")).withColumn("set_key", F.xxhash64("tokens")), "parsed")
    base = scratch.write(with_list_verdict(base, rules), "base")
    scratch.drop("parsed")
    if labelled is None:
        learn = base.filter("listed IS NOT NULL").select("tokens", F.col("listed").alias("verdict"), F.col("url").alias("sample_key"))
    else:
        learn = parsed(labelled.select("url", "verdict")).select("tokens", "verdict", F.col("url").alias("sample_key"))
    found = scratch.write(mine(learn).coalesce(1), "rules")
    sets = scratch.write(base.filter("listed IS NULL").groupBy("set_key").agg(F.first("tokens").alias("tokens")), "sets")
    every = base.groupBy("set_key").agg(F.count("*").alias("n")).join(judge(sets, found), "set_key", "left")
    out = join_keyed(base, scratch.write(every, "judged"), ["set_key"], "n")
    hit = F.col("listed").isNull() & F.col("mined_rule").isNotNull()
    return out.select("page_id", "url", "host", "path", "rule",
                      F.coalesce("listed", F.when(hit, "block").otherwise("allow")).alias("verdict"),
                      F.when(hit, F.col("mined_rule")).alias("mined_rule"), F.when(hit, F.col("confidence")).alias("confidence"))


def op8(spark, sf_dir) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "mined_rule", F.round("confidence", 6).alias("confidence"))
