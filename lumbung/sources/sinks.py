"""Writers. Each returns what was written, so that callers can check the count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lumbung.sources import versions
from lumbung.sources.readers import PRICE_COLUMNS

FACT = "fact_supply_resilience"


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for every table, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def save_parquet(tables: Mapping[str, DataFrame], folder: str, partition_fact_by: str | None = "tahun") -> None:
    """Replace one Parquet folder per table.

    Dimensions are single files. A fact with the partition column is split by it; its rows are
    shuffled by year and key first, so that a year becomes a few files instead of one per task.
    """
    for name, df in tables.items():
        if name.startswith("fact") and partition_fact_by in df.columns:
            spread = df.repartition(F.col(partition_fact_by), F.col("prov_key"))
            spread.write.mode("overwrite").partitionBy(partition_fact_by).parquet(f"{folder}/{name}")
        elif name.startswith("dim_") or name.startswith("ref_"):
            df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_back(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def load_table(df: DataFrame, folder: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace a warehouse table: lower-case names, wanted columns only; failures are raised."""
    out = df.toDF(*[c.lower() for c in df.columns])
    if columns:
        out = out.select(*[c for c in columns if c in out.columns])
    out.write.mode("overwrite").parquet(f"{folder}/{table}")
    return df.sparkSession.read.parquet(f"{folder}/{table}")


def checksums(df: DataFrame, by: str) -> dict[str, str]:
    """Number and order-free checksum of the rows of each value of ``by``, in one pass.

    Sums of two 64-bit hashes of whole rows; the driver gets one row for each value.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = [c.isNull() for c in columns]  # nulls alone leave no trace in a hash
    hashes = df.select(versions.value_of(by).alias("value"), F.xxhash64(*columns, *nulls).alias("a"), F.xxhash64(F.lit(1), *columns, *nulls).alias("b"))
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string") for c in ("a", "b")]
    rows = hashes.groupBy("value").agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums).alias("sum")).collect()
    return {r["value"]: r["sum"] for r in rows}


def load_fact(df: DataFrame, folder: str, table: str, by: str, counts: Mapping[str, Column]) -> dict[str, int]:
    """Write a fact table, a folder for each value of ``by``, and return the ``counts`` taken of its rows meanwhile.

    Rows are dealt out by ``by``; values that hold many rows are split over tasks. Counts are taken
    in the tasks that write, so that repeated tasks do not count twice.
    """
    seen = Observation(f"load-{table}")
    spread = df.hint("rebalance", by).observe(seen, *[c.alias(name) for name, c in counts.items()])
    spread.write.mode("errorifexists").partitionBy(by).parquet(f"{folder}/{table}")
    return seen.get


def append_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000, **options: str) -> None:
    """Append to a database table; run it on a partitioned frame to write in parallel."""
    df.write.option("batchsize", batch).jdbc(url, table, mode="append", properties=options)


def snapshot(tables: Mapping[str, DataFrame], folder: str) -> dict[str, Exception | None]:
    """Copy tables as they are. A table that fails is reported and does not stop the others."""
    outcome: dict[str, Exception | None] = {}
    for name, df in tables.items():
        try:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            outcome[name] = None
        except Exception as error:  # the caller decides what a failed table means
            outcome[name] = error
    return outcome


def export_csv(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    """Range-partitioned, sorted CSV: files in name order hold the rows in order."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def export_cube(cube: DataFrame, path: str) -> None:
    export_csv(cube, path, ["tahun", "bulan", "nama_provinsi", "nama_komoditas"])


def export_prices(prices: DataFrame, path: str) -> None:
    prices.select(*PRICE_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
