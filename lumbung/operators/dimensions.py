"""Dimension tables with surrogate keys.

Surrogate keys need one global order. Only distinct names and months are numbered that way, never
facts, so the single-partition window sees no more rows than the dimension has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumbung.functions import dates
from lumbung.session import stage
from lumbung.sources.fixed_values import COMMODITIES
from lumbung.sources.literals import literal_table


def numbered(df: DataFrame, order: Sequence[str | Column], key: str) -> DataFrame:
    return df.withColumn(key, F.row_number().over(W.orderBy(*order)))


def region_ids(df: DataFrame, name: str = "provinsi") -> DataFrame:
    """(id_wilayah, provinsi): distinct names numbered alphabetically."""
    return numbered(df.select(name).distinct(), [name], "id_wilayah").select("id_wilayah", name)


def region_dimension(names: DataFrame, name: str = "provinsi", known: DataFrame | None = None) -> DataFrame:
    """dim_prov: one row per distinct name, keyed in name order; behind the ``known`` ones, if there are any."""
    distinct = names.select(F.col(name).alias("nama_provinsi")).where(F.col(name).isNotNull()).distinct()
    if known is None:
        keyed = numbered(distinct, ["nama_provinsi"], "prov_key")
    else:
        keyed = with_lasting_keys(distinct, ["nama_provinsi"], "prov_key", known)
    return keyed.select(
        "prov_key", F.col("prov_key").alias("id_prov"), "nama_provinsi"
    )


def with_lasting_keys(df: DataFrame, order: Sequence[str], key: str, known: DataFrame) -> DataFrame:
    """``order`` and ``key`` of ``known`` as they are, and the next free keys for the rows of ``df`` that are not in it.

    New rows are sorted into ranges; each range numbers its own rows, behind the rows of the ranges
    before it. Only the sizes of the ranges pass through one task. Rows that ``df`` no longer has
    keep their keys. Nulls must not occur in ``order``.
    """
    known = known.select(*order, key)
    new = df.select(*order).distinct().join(known.select(*order), list(order), "left_anti")
    place = F.monotonically_increasing_id()
    sorted_ = new.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *order, F.shiftright(place, 33).alias("_range"), (place.bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("_at")
    )
    sorted_ = stage(sorted_, "new-keys")
    sizes = sorted_.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    last = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("_last")).scalar()
    starts = sizes.select("_range", (before + last).alias("_start"))
    numbered_ = sorted_.join(starts, "_range").select(*order, (F.col("_start") + F.col("_at")).cast("int").alias(key))
    return known.select(*order, F.col(key).cast("int")).unionByName(numbered_)


def commodity_dimension(spark: SparkSession, commodities: Sequence[tuple[int, str]] = COMMODITIES) -> DataFrame:
    """dim_komoditas from a fixed list."""
    return literal_table(
        spark, ["komoditas_key", "id_komoditas", "nama_komoditas"], [(i, i, name) for i, name in commodities]
    )


def commodity_dimension_of(names: DataFrame, name: str) -> DataFrame:
    """dim_komoditas from the distinct names of a column."""
    distinct = names.select(F.col(name).alias("nama_komoditas")).distinct()
    return numbered(distinct, ["nama_komoditas"], "komoditas_key").select(
        "komoditas_key", F.col("komoditas_key").alias("id_komoditas"), "nama_komoditas"
    )


def month_spine(bounds: DataFrame) -> DataFrame:
    """Every (tahun, bulan) from January of the first to December of the last year.

    ``bounds`` has one row with the integers ``first`` and ``last``; it may be lazy, no value
    goes through the driver.
    """
    months = F.sequence(
        F.make_date("first", F.lit(1), F.lit(1)), F.make_date("last", F.lit(12), F.lit(1)),
        F.expr("interval 1 month"),
    )
    return bounds.select(F.explode(months).alias("d")).select(
        F.year("d").alias("tahun"), F.month("d").alias("bulan")
    )


def year_bounds(df: DataFrame, year: str = "tahun") -> DataFrame:
    return df.agg(F.min(year).alias("first"), F.max(year).alias("last"))


def calendar_attributes(months: DataFrame) -> DataFrame:
    return months.withColumns(
        {"kuartal": dates.quarter_of(F.col("bulan")), "nama_bulan": dates.month_name(F.col("bulan"))}
    )


def time_dimension(months: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """dim_waktu: keyed in month order, behind the ``known`` months if there are any, with quarter and month name."""
    order = ["tahun", "bulan"]
    keyed = numbered(months, order, "waktu_key") if known is None else with_lasting_keys(months, order, "waktu_key", known)
    return calendar_attributes(keyed).select(
        "waktu_key", "bulan", "nama_bulan", "kuartal", "tahun"
    )


def with_code(df: DataFrame, name: str, codes: Mapping[str, str], column: str = "kode_bps") -> DataFrame:
    """Official code by exact name; unknown names get null."""
    lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return df.withColumn(column, F.try_element_at(lookup, F.col(name)))
