"""Monthly measures per region and commodity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.operators.conform import join_by_name
from lumbung.operators.reshape import stack

KEYS = ["id_wilayah", "bulan", "tahun", "id_komoditas"]


def monthly_sums(
    events: DataFrame, region: str, date: str, sums: Mapping[str, str], animals: DataFrame, animal: str = "id_hewan",
) -> DataFrame:
    """Sums per region, month and commodity of one event table.

    Events are summed by their raw animal id first. Only those few rows meet the lookup
    (``id_hewan`` to ``id_komoditas``), so a region or animal with most of the events costs no
    more than any other.
    """
    raw = events.groupBy(
        F.col(region).alias("id_wilayah"), F.col(f"{date}_bulan").alias("bulan"),
        F.col(f"{date}_tahun").alias("tahun"), F.col(animal).alias("id_hewan"),
    ).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    coded = raw.join(animals.select("id_hewan", "id_komoditas"), "id_hewan", "left")
    coded = coded.withColumn("id_komoditas", F.coalesce("id_komoditas", F.lit(0)))
    return coded.groupBy(*KEYS).agg(*[F.sum(name).alias(name) for name in sums])


def sums_by(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Plain grouped sums; a group of nulls gives null."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(name) for name, c in sums.items()])


def monthly_price(prices: DataFrame, regions: DataFrame, codes: Column, value: str = "harga") -> DataFrame:
    """Mean price per region, month and commodity, for prices whose region is known.

    Prices are reduced to sums and counts per raw name before they meet the dimension.
    """
    coded = prices.withColumn("id_komoditas", codes)
    small = coded.groupBy("provinsi", "bulan", "tahun", "id_komoditas").agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n")
    )
    return mean_price(small, regions, F.col("id_komoditas"))


def mean_price(sums: DataFrame, regions: DataFrame, codes: Column) -> DataFrame:
    """Mean price per region, month and commodity from _sum and _n per raw name."""
    small = sums.withColumn("id_komoditas", codes)
    known = join_by_name(small, regions.select("id_prov", "nama_provinsi"), "provinsi", "nama_provinsi", "inner")
    mean = F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_harga")
    return known.withColumnRenamed("id_prov", "id_wilayah").groupBy(*KEYS).agg(mean)


def merge_measures(frames: Sequence[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """Full outer merge of frames that are unique per key, in one shuffle.

    Stacked rows are grouped by key; each measure has at most one value per key. Rows with a
    null key part (unreadable dates) match nothing later on and are dropped first.
    """
    measures = [c for df in frames for c in df.columns if c not in keys]
    padded = [
        df.dropna(subset=list(keys)).select(
            *keys, *[F.col(m) if m in df.columns else F.lit(None).cast("double").alias(m) for m in measures]
        )
        for df in frames
    ]
    return stack(padded).groupBy(*keys).agg(*[F.max(m).alias(m) for m in measures])


def with_demography(stats: DataFrame, demography: DataFrame, keys: Sequence[str] = ("id_wilayah", "tahun")) -> DataFrame:
    return stats.join(demography, list(keys), "left")


def month_by_year(monthly: DataFrame, annual: DataFrame) -> DataFrame:
    """Monthly rows with the annual row of their region, commodity and year."""
    return monthly.join(annual, ["id_wilayah", "id_komoditas", "tahun"], "inner")
