"""Slice, dice, roll-up and drill-down."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lumbung.operators.explorer import explore
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.workload.base import on_cube, query, r

RISK, PRICE = r("avg(supply_risk_index)", 4), r("avg(avg_harga)", 0)


@query("m1_slice_commodity", on_cube(f"""
SELECT nama_provinsi, tahun, bulan, {RISK} AS risk, {PRICE} AS avg_harga FROM cube WHERE nama_komoditas = 'SMALL' GROUP BY ALL"""))
def slice_commodity(t: Source) -> DataFrame:
    return explore(standin.cube(t), "slice_kom", "SMALL")


@query("m2_slice_region", on_cube(f"""
SELECT nama_komoditas, tahun, bulan, {RISK} AS risk, {PRICE} AS avg_harga FROM cube WHERE nama_provinsi = 'NATION_3' GROUP BY ALL"""))
def slice_region(t: Source) -> DataFrame:
    return explore(standin.cube(t), "slice_prov", "NATION_3")


@query("m3_slice_year", on_cube(f"""
SELECT nama_provinsi, nama_komoditas, bulan, {RISK} AS risk FROM cube WHERE tahun = 1999 GROUP BY ALL"""))
def slice_year(t: Source) -> DataFrame:
    return explore(standin.cube(t), "slice_thn", 1999)


@query("m4_dice", on_cube("""
SELECT bulan, nama_bulan, supply_risk_index, avg_harga, sum_jumlah_sakit FROM cube
WHERE nama_komoditas = 'PROMO' AND nama_provinsi = 'NATION_3' AND tahun = 1999"""))
def dice(t: Source) -> DataFrame:
    return explore(standin.cube(t), "dice", "PROMO", "NATION_3", 1999)


@query("m5_roll_up_year", on_cube(f"""
SELECT tahun, {RISK} AS avg_risk, {PRICE} AS avg_harga, sum(sum_jumlah_sakit) AS total_sakit FROM cube GROUP BY tahun"""))
def roll_up_year(t: Source) -> DataFrame:
    return explore(standin.cube(t), "rollup_thn")


@query("m6_roll_up_region", on_cube(f"""
SELECT nama_provinsi, nama_komoditas, {RISK} AS avg_risk, {PRICE} AS avg_harga, sum(sum_jumlah_sakit) AS total_sakit FROM cube GROUP BY ALL"""))
def roll_up_region(t: Source) -> DataFrame:
    return explore(standin.cube(t), "rollup_prov")


@query("m7_drill_down", on_cube("""
SELECT bulan, nama_bulan, nama_komoditas, supply_risk_index, avg_harga, sum_jumlah_sakit FROM cube
WHERE nama_provinsi = 'NATION_3' AND tahun = 1999"""))
def drill_down(t: Source) -> DataFrame:
    return explore(standin.cube(t), "drilldown", "NATION_3", 1999)
