"""URL filter: given rules first, then association rules mined from labelled URLs."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label:bad"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does; of equally long ones, block."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: labels of the host, its registered domain, and pieces of the path, numbers as ``#``."""
    labels = F.filter(F.split(host, r"[.:@]"), lambda x: x != "")
    domain = F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))
    words = F.filter(F.split(F.lower(path), r"[/._\-~%]+"), lambda x: x != "")
    pieces = F.transform(words, lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "#")))
    hosts = F.transform(labels, lambda x: F.concat(F.lit("h:"), x))
    return F.array_distinct(F.concat(hosts, F.array(F.concat(F.lit("d:"), domain)), pieces))


#: Rows that one explode makes of a count, so that no array grows with a group.
REPEATED = 4096


def repeated(counted: DataFrame, n: str) -> DataFrame:
    """Every row of ``counted`` as often as its column ``n`` says."""
    chunks = counted.withColumn("begin", F.explode(F.sequence(F.lit(1), n, F.lit(REPEATED))))
    dealt = chunks.where(F.col(n) <= REPEATED).union(chunks.where(F.col(n) > REPEATED).repartition("begin"))
    times = F.sequence("begin", F.least(n, F.col("begin") + F.lit(REPEATED - 1)))
    return dealt.withColumn("time", F.explode(times)).drop("begin", "time", n)


def token_classes(sets: DataFrame, least: int) -> DataFrame:
    """(token, class): tokens that ``least`` bad URLs have, those that occur in exactly the same labelled URLs as one class.

    No rule can have any other token, and tokens of a class take part in the same combinations, so
    mining sees one of them. Two 64-bit checksums over the URLs of a token tell its class. There are
    at most as many frequent tokens as a bad URL has on average, over the least support.
    """
    seen = sets.select(
        "bad", "n", F.xxhash64("tokens", "bad").alias("a"), F.xxhash64(F.lit(1), "tokens", "bad").alias("b"), F.explode("tokens").alias("token")
    )
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("a", "b")]
    counts = seen.groupBy("token").agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n"), *sums)
    frequent = counts.where(F.col("bad") >= least)
    return frequent.select("token", F.min("token").over(Window.partitionBy("n", "a", "b")).alias("class"))


def mine(labelled: DataFrame, min_support: float, min_confidence: float, min_count: int = 20) -> tuple[DataFrame, DataFrame]:
    """Combinations of tokens in ``labelled`` (tokens, bad) that imply bad, and the classes of tokens that they are made of.

    The rules (rule, antecedent, support, confidence) hold for combinations that occur, bad, in a
    share ``min_support`` of the labelled URLs and in ``min_count`` of them, and are bad in a share
    ``min_confidence`` of their occurrences. An antecedent is an array of classes; it is met by a
    URL that has a token of each. All labelled URLs are mined with all their tokens. The frequent
    combinations of a URL can be as many as two to the power of its frequent classes.
    """
    spark = labelled.sparkSession
    number = F.monotonically_increasing_id().alias("number")
    sets = stage(labelled.groupBy("tokens", "bad").agg(F.count(F.lit(1)).alias("n")).select(number, "tokens", "bad", "n"), "url-sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    if not total:
        shape = "rule string, antecedent array<string>, support double, confidence double"
        return spark.createDataFrame([], shape), spark.createDataFrame([], "token string, class string")
    min_support = min(1.0, max(min_support, min_count / total))
    members = stage(token_classes(sets, math.ceil(min_support * total)), "token-classes")
    found = sets.select("number", F.explode("tokens").alias("token")).join(members, "token")
    found = found.groupBy("number").agg(F.collect_set("class").alias("classes"))
    items = F.concat(F.coalesce("classes", F.array().cast("array<string>")), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>")))
    rows = sets.select("number", "bad", "n").join(found, "number", "left").select(items.alias("items"), "n")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(repeated(rows, "n"))
    rules = model.associationRules.where(F.col("consequent")[0] == BAD)
    rules = rules.select(F.array_sort("antecedent").alias("antecedent"), "support", "confidence")
    return rules.select(F.array_join("antecedent", " ").alias("rule"), "antecedent", "support", "confidence"), members


def blocked(sets: DataFrame, rules: DataFrame, members: DataFrame) -> DataFrame:
    """The ``tokens`` of ``sets`` (number, tokens; all different) that meet the antecedent of some rule.

    An inverted index: each rule is filed under its class that fewest sets have, so a set meets a
    rule only at that one class, and the rest of the antecedent is then looked up in the set.
    """
    wanted = members.join(rules.select(F.explode("antecedent").alias("class")).distinct(), "class", "left_semi")
    listed = sets.select("number", F.explode("tokens").alias("token")).join(wanted, "token").select("number", "class").distinct()
    counts = listed.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    spread = rules.select("rule", "antecedent", F.explode("antecedent").alias("class")).join(counts, "class")
    index = spread.groupBy("rule", "antecedent").agg(F.min_by("class", F.struct("n", "class")).alias("class"))
    whole = listed.groupBy("number").agg(F.collect_set("class").alias("classes"))
    met = listed.join(index, "class").select("number", "antecedent").join(whole, "number")
    met = met.where(F.size(F.array_except("antecedent", "classes")) == 0).select("number").distinct()
    return sets.join(met, "number", "left_semi").select("tokens")


#: Tasks over which URLs with one set of tokens are dealt out.
SALTS = 32


def judge_urls(
    pages: DataFrame,
    labelled: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    min_support: float = 0.002,
    min_confidence: float = 0.8,
) -> DataFrame:
    """Per row: ``id_col``, host, path, rule (the longest given rule that fits, else null) and verdict.

    The verdict is that of the rule; without one it is block where a mined rule fits, else allow.
    ``labelled`` has columns url and bad; rows with a null label are left out, those with null URLs
    have no tokens. Null URLs, and those without ``://``, have empty host and path and are allowed
    unless a rule says otherwise. Repeated rows give repeated results, null ids stay, empty tables
    give empty results or no mined rules, other columns are not read. All steps are DataFrame
    functions; URLs are reduced to distinct token sets before they meet the mined rules, and dealt out
    when they get the verdict of their set, as a site's pages may all share one.
    """
    url = F.col(url_col).cast("string")
    split = pages.select(F.col(id_col), host(url).alias("host"), path(url).alias("path"))
    urls = split.withColumn("tokens", tokens(F.col("host"), F.col("path")))
    known = labelled.where("bad is not null").select(tokens(host(F.col("url")), path(F.col("url"))).alias("tokens"), "bad")
    mined, members = mine(known, min_support, min_confidence)
    mined = stage(mined, "url-rules")
    sets = stage(urls.select("tokens").distinct().select(F.monotonically_increasing_id().alias("number"), "tokens"), "url-sets")
    hits = blocked(sets, mined, members).select("tokens", F.lit(True).alias("hit"))
    hits = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = urls.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    judged = salted.join(hits, ["tokens", "salt"], "left")
    found = longest_rule(rules, F.col("host"), F.col("path"))
    method = F.when(F.col("hit"), "block").otherwise("allow")
    judged = judged.withColumn("found", found)
    return judged.select(
        id_col, "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", method).alias("verdict")
    )
