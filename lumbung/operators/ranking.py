"""Top-k lists. All have a full order, so equal values never make a result random."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions import dates
from lumbung.operators.rollups import RISK, mean_by


def top(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """First k rows. Spark keeps k rows per task and merges them; nothing is sorted globally."""
    return df.orderBy(*order).limit(k)


def top_index_rows(cube: DataFrame, k: int = 10) -> DataFrame:
    rows = cube.select(
        "nama_provinsi", "tahun", "bulan", "nama_komoditas", RISK, "sum_jumlah_sakit", "populasi_ternak"
    )
    return top(rows, [F.desc(RISK), "nama_provinsi", "tahun", "bulan", "nama_komoditas"], k)


def top_regions(cube: DataFrame, k: int = 10) -> DataFrame:
    return top(mean_by(cube, ["nama_provinsi"]), [F.desc("avg_risk"), "nama_provinsi"], k)


def top_region_timeline(cube: DataFrame, k: int = 5) -> DataFrame:
    """Monthly risk of the k regions with the highest mean."""
    best = top_regions(cube, k).select("nama_provinsi")
    out = cube.join(best, "nama_provinsi", "left_semi")
    out = out.groupBy("tahun", "bulan", "nama_provinsi").agg(F.avg(RISK).alias("risk"))
    return out.withColumn("periode", dates.period_slash(F.col("tahun"), F.col("bulan")))


def deepest_deficits(gaps: DataFrame, k: int = 12) -> DataFrame:
    return top(gaps, ["gap", "nama_provinsi", "nama_komoditas"], k)


def top_suppliers(concentration: DataFrame, k: int) -> DataFrame:
    return top(concentration, [F.desc("sum_vol"), "nama_provinsi"], k)


def choices(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Sorted distinct values of a filter list."""
    return df.select(column).distinct().orderBy(F.desc(column) if descending else F.asc(column))


def default_selection(available: DataFrame, defaults: DataFrame, fallback: int = 3) -> DataFrame:
    """Defaults that are available; if there is none, the first available values."""
    column = available.columns[0]
    known = available.select(column).distinct()
    wanted = known.intersect(defaults.select(column))
    found = wanted.agg(F.count(F.lit(1))).scalar()
    first = known.orderBy(column).limit(fallback).where(found == 0)
    return wanted.unionByName(first)
