"""Each corpus operator with production parameters, applied to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm import bpe, conversations, importance, langid, mixing, simhash, spaced, suffix, token_files, toxicity, url_rules, warc, weak
from lumbung.llm.conversations_sql import repair_sql
from lumbung.llm.importance_sql import resample_sql
from lumbung.llm.mixing_sql import mixture_sql
from lumbung.llm.targets import TARGETS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.count_tokens(table(spark, folder, "documents"), limit=4096)


@query
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the mixture reads, and how often."""
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"), TARGETS)
    return mixed.select("doc_id", "domain", "lang", "source", mixing.n_tokens(F.col("text")).alias("n_tokens"), "copies")


ORACLES["op2_mixing"] = mixture_sql(TARGETS)


@query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


URL_RULES = [
    url_rules.Rule("allow", "com", "/"),
    url_rules.Rule("block", "example.com", "/en/"),
    url_rules.Rule("allow", "www.example.com", "/en/"),
    url_rules.Rule("block", "net", "/es/"),
    url_rules.Rule("block", "net", "/fr/"),
]


@query
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Labels belong to documents; the last number of a page's path is that of its document. Bad are low quality and toxic ones."""
    pages = table(spark, folder, "pages")
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    number = F.regexp_extract(url_rules.path(F.col("url")), r"/([0-9]{1,18})[^0-9/]*/?$", 1)
    linked = pages.select("url", F.when(number != "", number.cast("bigint")).alias("doc_id"))
    return url_rules.judge_urls(pages, linked.join(labels, "doc_id").select("url", "bad"), URL_RULES)


@query
def op5_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(table(spark, folder, "documents"), shingle=3, distance=2)


@query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return weak.judge(table(spark, folder, "documents"))


@query
def op7_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages"), min_bytes=0)


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return spaced.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])


@query
def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, folder, "documents"), length=100)


@query
def op11_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op11_importance"] = resample_sql()


@query
def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.write_and_read(table(spark, folder, "documents"), end_id=2)


@query
def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged conversations, repaired; those that lost all rows are reported too."""
    rows = table(spark, folder, "conversations")
    return conversations.repair(conversations.damage(rows), rows)


ORACLES["op13_conversations"] = repair_sql()
