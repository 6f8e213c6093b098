"""URL verdicts: fixed host and path rules first, then mined token combinations.

FP-growth over the tokens of labelled URLs finds combinations that go with the label "block". Rules below a support
or a confidence are pruned, and so are rules with a shorter one inside that is as sure. What is left is an inverted
index from each rule's rarest token to the rule; a URL is blocked if it holds all tokens of some rule.

The support is a number of blocked pages, so the same evidence gives the same rule in a table of any size. Rules of one
token are found by counting. Tokens that are no part of a longer rule are taken out before mining: those with too few
blocked pages, those that all labelled pages hold, and those that no other token can make surer.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.core import UPPER, stored

# The rules of the contract, host, path and verdict.
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
LEAST_ROWS, CONFIDENCE = 20, 0.9
BLOCK = "=block"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL: host labels and suffixes, path words, file type, query keys, fragment.

    Digits become 0, so that numbers of one length are one token; none for null or no ``://``.
    """
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    named = lambda kind, words: F.transform(words, lambda w: F.concat(F.lit(f"{kind}:"), w))
    plain = lambda words: F.filter(
        F.transform(words, lambda w: F.regexp_replace(F.lower(w), r"\d", "0")), lambda w: w != "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "(?s)^([^=]*)", 1))
    site = F.array_join(F.slice(labels, -2, 2), ".")
    return F.array_distinct(F.filter(F.concat(
        named("host", plain(labels)), named("site", plain(F.when(F.size(labels) > 1, F.array(site)).otherwise(F.array()))),
        named("path", plain(F.split(path, r"[^\p{L}\p{N}]+"))), named("key", plain(keys)),
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array()),
        named("scheme", plain(F.array(F.regexp_extract(url, r"(?s)^(.*?)://", 1)))),
    ), lambda t: (host != "") & t.isNotNull()))


def mined_rules(pages: DataFrame, labels: DataFrame, confidence: float = CONFIDENCE, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(anchor, tokens, confidence): token combinations that mean "block".

    A label belongs to the page of its doc_id and says "block" with quality 0 or toxic 1; all labelled pages are
    mined. Labels of one page that disagree count as a page each, equal ones once. A rule holds for ``least_rows``
    blocked pages or more, and these are the share ``confidence`` of the labelled pages that it fits, or more.
    """
    marks = labels.select(F.col("doc_id").alias("page_id"), (
        (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad")).distinct()
    known = pages.select("page_id", tokens_of(F.col("url")).alias("t")).where(F.size("t") > 0).join(marks, "page_id")
    known = stored(known.select(F.monotonically_increasing_id().alias("b"), "bad", "t"), "url-baskets")
    rows = known.count()
    if not rows:
        return known.sparkSession.createDataFrame([], "anchor string, tokens array<string>, confidence double")
    bad = F.col("bad").cast("bigint")
    counts = stored(known.select("bad", F.explode("t").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.sum(bad).alias("n_bad")).where(F.col("n_bad") >= least_rows), "url-tokens")
    sure = F.col("n_bad") >= confidence * F.col("n")
    single = counts.where(sure).select(F.array("token").alias("tokens"), (F.col("n_bad") / F.col("n")).alias("confidence"))
    # A token of all pages changes no count; one whose pages are all blocked leaves no longer rule surer.
    useful = counts.where((F.col("n") < rows) & (F.col("n_bad") < F.col("n"))).select("token")
    baskets = known.select("b", "bad", F.explode("t").alias("token")).join(useful, "token").groupBy("b", "bad").agg(
        F.collect_list("token").alias("t"))
    baskets = stored(baskets.select(F.when(F.col("bad"), F.concat("t", F.array(F.lit(BLOCK)))).otherwise(F.col("t")).alias(
        "items")), "url-useful")
    n = max(baskets.count(), 1)
    # Half a row less, so that rounding the share back to rows gives least_rows.
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, max(0.0, (least_rows - 0.5) / n))).fit(baskets).freqItemsets
    found = stored(found.select(F.array_sort("items").alias("items"), "freq"), "url-itemsets")
    blocked = found.where(F.array_contains("items", BLOCK) & (F.size("items") > 2)).select(
        F.array_remove("items", BLOCK).alias("tokens"), F.col("freq").alias("n_bad"))
    longer = blocked.join(found.withColumnRenamed("items", "tokens"), "tokens").where(
        F.col("n_bad") >= confidence * F.col("freq")).select("tokens", (F.col("n_bad") / F.col("freq")).alias("confidence"))
    ranked = single.union(longer).select("*", F.explode("tokens").alias("token")).join(counts, "token").groupBy(
        "tokens", "confidence").agg(F.min(F.struct("n", "token"))["token"].alias("anchor"))
    ranked = stored(ranked.select("anchor", "tokens", "confidence"), "url-rules")
    # A rule goes if one with fewer tokens, all among its own, is as sure.
    inner = ranked.select(F.col("anchor").alias("a"), F.col("tokens").alias("fewer"), F.col("confidence").alias("c"))
    wider = ranked.select("tokens", "confidence", F.explode("tokens").alias("a")).join(inner, "a").where(
        (F.size("fewer") < F.size("tokens")) & (F.col("c") >= F.col("confidence"))
        & (F.size(F.array_except("fewer", "tokens")) == 0)).select("tokens").distinct()
    return ranked.join(wider, "tokens", "left_anti").select("anchor", "tokens", "confidence")


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    Null URLs and URLs without ``://`` have an empty host and path, no rule, and are allowed. Verdicts depend on the
    URL and the labels only; repeated rows get equal ones. Without labelled pages nothing but the fixed rules blocks.
    """
    rules = stored(mined_rules(pages, labels), "url-index")
    own = pages.select("page_id", "url")
    hit = own.select("page_id", "url", tokens_of(F.col("url")).alias("own")).select(
        "page_id", "url", "own", F.explode("own").alias("anchor")).join(rules, "anchor").where(
        F.size(F.array_except("tokens", "own")) == 0).select(
        F.col("page_id").alias("p"), F.col("url").alias("u"), F.lit("block").alias("mined")).distinct()
    out = own.join(hit, F.col("page_id").eqNullSafe(F.col("p")) & F.col("url").eqNullSafe(F.col("u")), "left")
    out = out.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "mined")
    out = out.withColumn("fixed", fixed_rule(F.col("host"), F.col("path")))
    return out.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.coalesce(
        F.col("fixed.verdict"), F.col("mined"), F.lit("allow")).alias("verdict"))
