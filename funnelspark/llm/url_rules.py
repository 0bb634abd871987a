"""URL filters by association rules: FP-growth over URL tokens and labels, rules matched by an inverted index.

A URL's tokens are all labels of its host, all parts of its path and all its query parameters, numbers as one token. Pages
with a label are baskets of their tokens. FP-growth mines the item sets of the bad baskets that at least ``LEAST`` of them
hold, of ``MOST_TOKENS`` tokens at most; an item set is a rule ``tokens -> bad`` if its confidence over all labelled baskets lies above the share of bad ones by
``Z`` standard errors, and if it is more confident than each rule with one token less. Tokens that the same baskets hold
are one item, so long URLs that repeat don't multiply item sets. Every rule is filed under its rarest token: a page meets
only rules that share that token, and is held against the rest of their tokens there.

Nothing of a URL is cut off, and whether a set is a rule depends on nothing but its own baskets and the share of bad ones. Where
long baskets could make FP-growth list more than ``MOST_SETS`` sets, the same sets are found by growth of bounded length.

Fixed rules by host and path come first: one fits its host and all its subdomains where the path begins with its own;
the longest wins. Other pages are blocked if a mined rule fits.

Nulls: a URL that is null or has no ``://`` has an empty host and path and no tokens; verdict allow. Pages repeat row by
row; labels of a doc that repeat each make a basket. Other columns are ignored. Without labels there are no mined rules.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelspark.llm._spark import broadcast_if, cut
from funnelspark.llm.decontaminate import LOWER, UPPER

#: verdict, host, path
FIXED_RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
#: Bad baskets that hold a rule at least; standard errors above the share of bad baskets; tokens of a rule at most.
LEAST, Z, MOST_TOKENS = 5, 2.0, 4
#: Item sets of any length that FP-growth may be made to list.
MOST_SETS = 10_000_000
BROADCAST_RULES = 200_000
RULES = "tokens array<string>, confidence double, n long"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def query(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))


def tokens(host: Column, path: Column, query: Column) -> Column:
    """Distinct h: labels of the host, p: parts of the path, q: parameters of the query, in order; numbers as 0."""
    parts = lambda text, split, mark: F.transform(F.filter(F.split(text, split), lambda x: x != ""), lambda x: F.concat(F.lit(mark), F.regexp_replace(x, "[0-9]+", "0")))
    return F.array_sort(F.array_distinct(F.concat(parts(host, r"\.", "h:"), parts(path, "/", "p:"), parts(query, "[&;]", "q:"))))


def fixed_rule(host: Column, path: Column, rules=FIXED_RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null fields if none does."""
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def frequent_items(baskets: DataFrame, least: int) -> DataFrame:
    """``items`` of the bad baskets(id, tokens, bad), cut down to tokens that ``least`` of them hold, one of those that always meet."""
    posted = baskets.select("id", "bad", F.explode("tokens").alias("token"))
    mark = F.xxhash64("id")
    held = posted.groupBy("token").agg(F.sum(F.col("bad").cast("long")).alias("n"), F.count("*").alias("all"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 20)).alias("s"))
    first = held.filter(F.col("n") >= least).groupBy("all", "x", "s").agg(F.min("token").alias("token")).select("token")
    first = broadcast_if(cut(first, "tokens"), BROADCAST_RULES)
    return cut(posted.filter("bad").join(first, "token", "left_semi").groupBy("id").agg(F.array_sort(F.collect_list("token")).alias("items")), "baskets")


def frequent_sets(items: DataFrame, least: int, most_tokens: int = MOST_TOKENS, most_sets: int = MOST_SETS) -> DataFrame:
    """(rule_tokens, n): sets of at most most_tokens tokens that ``least`` of the baskets ``items`` hold.

    FP-growth knows no bound on the length of a set, so it is used as long as the baskets can't give it more than most_sets of any
    length; beyond, the same sets are grown by projections that stop at most_tokens (PrefixSpan over tokens in order, where a
    subsequence is a set)."""
    size = items.agg(F.count("*").alias("n"), F.sum(F.pow(F.lit(2.0), F.size("items"))).alias("sets")).first()
    if size.n < least:
        return items.sparkSession.createDataFrame([], "rule_tokens array<string>, n long")
    share = (least - 0.5) / size.n
    if size.sets / least <= most_sets:
        found = FPGrowth(itemsCol="items", minSupport=share).fit(items.select("items")).freqItemsets.filter(F.size("items") <= most_tokens)
        return found.select(F.array_sort("items").alias("rule_tokens"), F.col("freq").alias("n"))
    steps = items.select(F.transform("items", lambda x: F.array(x)).alias("sequence"))
    found = PrefixSpan(minSupport=share, maxPatternLength=most_tokens, sequenceCol="sequence").findFrequentSequentialPatterns(steps)
    return found.select(F.flatten("sequence").alias("rule_tokens"), F.col("freq").alias("n"))


def mine(baskets: DataFrame, least: int = LEAST, z: float = Z, most_tokens: int = MOST_TOKENS, most_sets: int = MOST_SETS) -> DataFrame:
    """(tokens, confidence, n): rules tokens -> bad from baskets(id, tokens, bad) of distinct tokens."""
    total = baskets.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")).first()
    if not total.bad:
        return baskets.sparkSession.createDataFrame([], RULES)
    base = total.bad / total.n
    sets = cut(frequent_sets(frequent_items(baskets, least), least, most_tokens, most_sets), "sets")
    # the item sets' counts over all labelled baskets, alike ones counted once
    alike = baskets.groupBy("tokens").agg(F.count("*").alias("times"))
    met = matches(alike, sets).groupBy("rule_tokens").agg(F.sum("times").alias("of"), F.first("n").alias("n"))
    floor = F.lit(base) + z * F.sqrt(F.lit(base * (1 - base)) / F.col("of"))
    rules = met.withColumn("confidence", F.col("n") / F.col("of")).filter(F.col("confidence") >= floor)
    rules = cut(rules.select(F.col("rule_tokens").alias("tokens"), "confidence", "n"), "rules")
    # a longer rule stays only if it is more confident than each rule with one token less
    shorter = rules.select(F.posexplode("tokens").alias("i", "_"), "tokens", "confidence").select("tokens", "confidence", F.filter("tokens", lambda x, j: j != F.col("i")).alias("less"))
    beaten = shorter.join(rules.select(F.col("tokens").alias("less"), F.col("confidence").alias("c")), "less").filter("c >= confidence").select("tokens").distinct()
    return rules.join(beaten, "tokens", "left_anti")


def index(rules: DataFrame) -> DataFrame:
    """Each rule under the token that the fewest rules have."""
    posted = rules.select("*", F.explode("rule_tokens").alias("key"))
    often = posted.groupBy("key").agg(F.count("*").alias("posts"))
    first = F.row_number().over(W.partitionBy("rule_tokens").orderBy("posts", "key"))
    return posted.join(often, "key").withColumn("at", first).filter("at = 1").drop("at", "posts")


def matches(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows(tokens, ..) with each of rules(rule_tokens, ..) whose tokens they all hold."""
    posted = broadcast_if(cut(index(rules), "index"), BROADCAST_RULES)
    return rows.select("*", F.explode("tokens").alias("key")).join(posted, "key").filter(F.size(F.array_except("rule_tokens", "tokens")) == 0)


def judge(pages: DataFrame, labels: DataFrame, rules=FIXED_RULES, least: int = LEAST, z: float = Z) -> DataFrame:
    """page_id, host, path, rule, verdict, mined (a matching mined rule or null) of each row of pages(page_id, url); labels(doc_id, quality, toxic)."""
    h, p = host(F.col("url")), path(F.col("url"))
    urls = pages.select("page_id", h.alias("host"), p.alias("path"), tokens(h, p, query(F.col("url"))).alias("tokens"))
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    baskets = urls.join(labels.select("doc_id", bad.alias("bad")), F.col("page_id") == F.col("doc_id")).filter(F.size("tokens") > 0)
    baskets = cut(baskets.select(F.expr("uuid()").alias("id"), "tokens", "bad"), "labelled")
    mined = mine(baskets, least, z).select(F.col("tokens").alias("rule_tokens"), "confidence")
    # distinct sets of tokens meet the index once
    named = F.struct("confidence", F.array_join("rule_tokens", " & ").alias("rule"))
    met = matches(urls.select("tokens").distinct(), mined).groupBy("tokens").agg(F.max(named)["rule"].alias("mined"))
    out = urls.join(broadcast_if(cut(met, "met"), BROADCAST_RULES, 256), "tokens", "left").withColumn("f", fixed_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("f.verdict", F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("f.rule").alias("rule"), verdict.alias("verdict"), "mined")
