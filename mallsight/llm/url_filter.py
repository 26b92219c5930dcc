"""URL filtering by explicit rules and by association rules mined from labelled URLs.

A URL becomes a set of tokens (scheme, host labels, path segments, query names).  Spark's
FP-growth mines the token combinations that go along with the block label; combinations
with enough support and confidence become rules, which match through an inverted index from
their rarest token; tokens that always stand together are mined as one.  Explicit rules come first.  Only DataFrame functions and Spark ML run.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, landed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Item that marks a transaction as labelled "block"; no URL token has its form.
BLOCKED = "label:block"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def explicit_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest fitting rule, else NULLs.

    ``rules`` maps ``host/path`` to a verdict; it is a short list given by the caller.  A rule
    fits its host and every subdomain of it when the path starts with the rule's path.
    """
    name = verdict = F.lit(None).cast("string")
    for rule, says in sorted(rules.items(), key=lambda r: (len(r[0]), r[0])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL: ``s:`` scheme, ``h:`` host labels, ``p:`` path segments, ``q:`` query names."""
    query = F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    marked = lambda mark, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    scheme = F.when(F.instr(url, "://") > 0, F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)).otherwise("")
    return F.array_distinct(F.concat(
        marked("s:", F.array(F.coalesce(scheme, F.lit("")))),
        marked("h:", F.split(host_of(url), r"\.")),
        marked("p:", F.split(path_of(url), "/")),
        marked("q:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)))))


def _fires(rule: str, names: str) -> Column:
    return F.size(F.array_except(rule, names)) == 0


def _none(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def mine_block_rules(labelled: DataFrame, min_pages: int, min_permille: int, min_percent: int) -> tuple[DataFrame, DataFrame]:
    """``rules(names, rarest)`` and ``named(token, name)`` mined from ``labelled(tokens, block)``.

    A rule is a set of any number of tokens that at least ``min_pages`` labelled pages and
    ``min_permille`` per mille of them carry along with the block label, and of whose pages at
    least ``min_percent`` % are blocked.  Only what can decide a verdict is mined:

    * A token that is a rule by itself is not mined further: a set that holds it fires where it does.
    * Tokens carried by exactly the same labelled pages share one ``name`` (the smallest), told by
      their page counts and 128 bits of exclusive or of row hashes.  Any of them stands for the name, so
      twenty query names of one site are one item instead of a million sets.
    * Sets that hold a smaller rule are left out.

    Tokens that stand together on nearly the same pages are still mined one by one.  A rule fires
    on a URL that holds a token of each of its names; ``rarest`` is its rarest name.
    """
    rows = landed(labelled.select("tokens", "block").filter(F.col("block") | (F.size("tokens") > 0))
                  .withColumn("row", F.monotonically_increasing_id()), "labelled-urls")
    n = rows.count()
    least = max(min_pages, -(-n * min_permille // 1000))
    held = rows.select("row", "block", F.explode("tokens").alias("token"))
    counts = landed(held.groupBy("token").agg(F.count("*").alias("pages"), F.count_if("block").alias("blocked"),
                                              F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y"))
                    .filter(F.col("blocked") >= least), "url-tokens")
    alone = F.col("blocked") * 100 >= F.col("pages") * min_percent
    single = counts.filter(alone).select(F.array("token").alias("names"), F.col("token").alias("rarest"))
    same = ["pages", "x", "y"]
    others = counts.filter(~alone)
    classes = landed(others.join(others.groupBy(*same).agg(F.min("token").alias("name")), same).select("token", "name", "pages"), "url-names")
    names = classes.filter("token = name").select("token")
    items = (held.join(beside(names), "token").groupBy("row", "block").agg(F.collect_list("token").alias("items"))
             .select(F.when(F.col("block"), F.concat("items", F.array(F.lit(BLOCKED)))).otherwise(F.col("items")).alias("items")))
    marked = landed(items, "transactions")
    found = _mined(marked, least, min_percent)
    held_names = found.select("rule_id", F.explode("names").alias("name"))
    freq = classes.filter("token = name").select("name", "pages")
    rarest = held_names.join(freq, "name").groupBy("rule_id").agg(F.min_by("name", F.struct("pages", "name")).alias("rarest"))
    keyed = landed(found.join(rarest, "rule_id"), "keyed-rules")
    smaller = keyed.select("rarest", F.col("names").alias("part"))
    larger = (found.select("rule_id", "names", F.explode("names").alias("rarest")).join(smaller, "rarest")
              .filter((F.size("part") < F.size("names")) & _fires("part", "names")).select("rule_id").distinct())
    rules = landed(keyed.join(larger, "rule_id", "left_anti").select("names", "rarest").unionByName(single), "url-rules")
    used = rules.select(F.explode("names").alias("name")).distinct()
    every = classes.select("token", "name").unionByName(single.select(F.col("rarest").alias("token"), F.col("rarest").alias("name")))
    return rules, landed(every.join(used, "name", "left_semi").select("token", "name"), "rule-tokens")


def _mined(marked: DataFrame, least: int, min_percent: int) -> DataFrame:
    """``(rule_id, names)`` of the sets of two names or more that block, by FP-growth over ``marked(items)``."""
    n = marked.count()
    if n < least:
        return _none(marked, "rule_id long, names array<string>")
    # FP-growth rounds support * n up; half a page less keeps the count whole
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=1.0).fit(marked)
    sets = landed(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    both = (sets.filter(F.array_contains("items", BLOCKED) & (F.size("items") > 2))
            .select(F.array_remove("items", BLOCKED).alias("items"), F.col("freq").alias("blocked")))
    return landed(both.join(sets.withColumnRenamed("freq", "pages"), "items")
                  .filter(F.col("blocked") * 100 >= F.col("pages") * min_percent)
                  .select(F.xxhash64("items").alias("rule_id"), F.col("items").alias("names")), "found-rules")


def judge(pages: DataFrame, labels: DataFrame, rules: dict[str, str], min_pages: int = 5, min_permille: int = 1,
          min_percent: int = 80, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, mined)`` for every row of ``pages``.

    ``labels(id, block)`` says which page ids are known to be blocked; ids may repeat (a page
    is labelled once for each row) and NULLs take no part.  A page takes its longest explicit
    rule's verdict; else ``block`` if a mined rule's tokens all occur in its URL (``mined``),
    else ``allow``.  A URL may hold any number of tokens; a repeated one counts once.  NULL URLs and URLs without ``://`` have empty host and path and no
    tokens.  Empty tables give no mined rules or an empty result; other columns are ignored.
    """
    url = F.col("url")
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    known = labels.filter("id is not null and block is not null").select(F.col("id").alias("page_id"), "block")
    rules_mined, named = mine_block_rules(base.join(known, "page_id").select(tokens_of(url).alias("tokens"), "block"),
                                          min_pages, min_permille, min_percent)
    # only tokens that rules name go on; a rule meets the URLs that hold its rarest name
    of_url = (base.select("url").filter("url is not null").distinct().select("url", F.explode(tokens_of(url)).alias("token"))
              .join(beside(named), "token").groupBy("url").agg(F.collect_set("name").alias("of_url")))
    fired = (of_url.select("url", "of_url", F.explode("of_url").alias("rarest"))
             .join(rules_mined, "rarest").filter(_fires("names", "of_url"))
             .select("url").distinct().withColumn("mined", F.lit(True)))
    host, path = host_of(url), path_of(url)
    rule, verdict = explicit_rule(F.col("host"), F.col("path"), rules)
    return (base.join(fired, "url", "left")
            .select("page_id", host.alias("host"), path.alias("path"), F.coalesce("mined", F.lit(False)).alias("mined"))
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"), "mined"))
