"""Slice, dice, roll-up and drill-down of the cube."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.numeric import stable_round
from lumbung.operators.rollups import RISK


def _risk(name: str) -> Column:
    return stable_round(f"avg({RISK})", 4).alias(name)


def _price() -> Column:
    return stable_round("avg(avg_harga)", 0).alias("avg_harga")


def _sick() -> Column:
    return F.coalesce(F.sum("sum_jumlah_sakit"), F.lit(0.0)).alias("total_sakit")


def slice_commodity(cube: DataFrame, commodity: str) -> DataFrame:
    rows = cube.where(F.col("nama_komoditas") == commodity)
    return rows.groupBy("nama_provinsi", "tahun", "bulan").agg(_risk("risk"), _price())


def slice_region(cube: DataFrame, region: str) -> DataFrame:
    rows = cube.where(F.col("nama_provinsi") == region)
    return rows.groupBy("nama_komoditas", "tahun", "bulan").agg(_risk("risk"), _price())


def slice_year(cube: DataFrame, year: int) -> DataFrame:
    rows = cube.where(F.col("tahun") == year)
    return rows.groupBy("nama_provinsi", "nama_komoditas", "bulan").agg(_risk("risk"))


def dice(cube: DataFrame, commodity: str, region: str, year: int) -> DataFrame:
    rows = cube.where(
        (F.col("nama_komoditas") == commodity) & (F.col("nama_provinsi") == region) & (F.col("tahun") == year)
    )
    return rows.select("bulan", "nama_bulan", RISK, "avg_harga", "sum_jumlah_sakit")


def roll_up_year(cube: DataFrame) -> DataFrame:
    return cube.groupBy("tahun").agg(_risk("avg_risk"), _price(), _sick())


def roll_up_region(cube: DataFrame) -> DataFrame:
    out = cube.groupBy("nama_provinsi", "nama_komoditas").agg(_risk("avg_risk"), _price(), _sick())
    return out.orderBy(F.desc("avg_risk"), "nama_provinsi", "nama_komoditas")


def drill_down(cube: DataFrame, region: str, year: int) -> DataFrame:
    rows = cube.where((F.col("nama_provinsi") == region) & (F.col("tahun") == year))
    return rows.orderBy("bulan", "nama_komoditas").select(
        "bulan", "nama_bulan", "nama_komoditas", RISK, "avg_harga", "sum_jumlah_sakit"
    )


OPERATIONS = {
    "slice_kom": slice_commodity,
    "slice_prov": slice_region,
    "slice_thn": slice_year,
    "dice": dice,
    "rollup_thn": roll_up_year,
    "rollup_prov": roll_up_region,
    "drilldown": drill_down,
}


def explore(cube: DataFrame, operation: str, *arguments: object) -> DataFrame:
    """Run an operation by name; an unknown name returns the cube itself."""
    run = OPERATIONS.get(operation)
    return cube if run is None else run(cube, *arguments)
