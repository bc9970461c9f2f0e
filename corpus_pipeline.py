"""A corpus made ready for training, stage by stage; every stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm import mixing, simhash, spaced, suffix, weak
from lumbung.llm.targets import TARGETS
from lumbung.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality go on."""
    return weak.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies goes on."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose every string of 100 bytes that also starts earlier; all documents go on, with their new length."""
    cut = suffix.without_repeats(docs, length=100)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark go on."""
    return spaced.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture reads, with their domain and how often they are read."""
    return mixing.mix(docs, TARGETS)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_copies),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", leaks),
    ("mixing sources to target weights", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"corpus-{i}")
    return docs


#: Fingerprints, the label model and suffix arrays have no SQL form; tests compare with brute force.
ORACLE_SQL = None
