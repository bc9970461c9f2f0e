"""Column functions and the quirks they must keep."""

import datetime

import pytest
from pyspark.sql import functions as F

from lumbung.functions import dates, numeric, risk, text
from lumbung.operators import cleaning, rollups
from lumbung.sources.fixed_values import REGION_ALIASES, REGION_CENTRES, REGION_CODES


def values(df, column, expression):
    return [r[0] for r in df.select(expression(F.col(column))).collect()]


def test_local_number(spark):
    df = spark.createDataFrame([("1.234,56",), ("12",), ("-",), (None,), ("1.000.000",), ("abc",)], "v string")
    assert values(df, "v", numeric.local_number) == [1234.56, 12.0, None, None, 1000000.0, None]


def test_stable_round_ignores_summation_noise(spark):
    df = spark.createDataFrame([(1234.565,), (1234.5649999999998,), (2.5,), (-2.5,), (0.285,)], "v double")
    assert values(df, "v", lambda c: numeric.stable_round(c, 2)) == [1234.57, 1234.57, 2.5, -2.5, 0.29]
    assert values(df, "v", lambda c: numeric.stable_round(c, 0))[2:4] == [3.0, -3.0]


def test_event_date_takes_both_year_lengths_padded_or_not(spark):
    df = spark.createDataFrame(
        [("03/16/24",), ("03/16/2024",), ("13/45/24",), ("2024-03-16",), (None,), ("01/02/60",), ("1/5/24",), (" 1/15/2024 ",), ("1/5/024",), ("003/1/24",), ("1/005/2024",), ("1/5",), ("1/5/24/",), ("/5/24",)], "v string"
    )
    d = datetime.date
    assert values(df, "v", dates.event_date) == [d(2024, 3, 16), d(2024, 3, 16), None, None, None, d(2060, 1, 2), d(2024, 1, 5), d(2024, 1, 15)] + [None] * 6


def test_header_date_ignores_blanks(spark):
    df = spark.createDataFrame([("02/ 01/ 2024",), ("2/1/2024",), ("x",)], "v string")
    assert values(df, "v", dates.header_date) == [datetime.date(2024, 1, 2)] * 2 + [None]


def test_period_labels(spark):
    row = spark.range(1).select(
        dates.period_slash(F.lit(2024), F.lit(3)), dates.period_dash(F.lit(2024), F.lit(3)),
        dates.period_quarter(F.lit(2024), F.lit(1)), dates.period_number(F.lit(2024), F.lit(3)),
        dates.month_name(F.lit(8)), dates.month_name(F.lit(13)), dates.quarter_of(F.lit(10)),
    ).first()
    assert tuple(row) == ("2024/03", "2024-03", "2024 Q1", 202403, "Agustus", None, 4)


def test_normalize_region(spark):
    df = spark.createDataFrame(
        [(" d.i. yogyakarta",), ("D.K.I. Jakarta",), ("Kep. Riau",), ("Kepulauan Kep. Riau",), ("Bali",)], "v string"
    )
    assert values(df, "v", text.normalize_region) == [
        "DI YOGYAKARTA", "DKI JAKARTA", "KEPULAUAN RIAU", "KEPULAUAN RIAU", "BALI",
    ]


def test_label_and_code(spark):
    df = spark.createDataFrame([("Daging SAPI murni",), ("ayam ras",), ("Kambing",), (None,)], "v string")
    labels = values(df, "v", lambda c: text.label_by_content(c, {"sapi": "Sapi", "ayam": "Ayam"}))
    assert labels == ["Sapi", "Ayam", "Kambing", None]
    df = spark.createDataFrame([("SAPI",), ("ayam",), ("sapi potong",), (None,)], "v string")
    assert values(df, "v", lambda c: text.code_by_name("v", {"sapi": 1, "ayam": 2})) == [1, 2, 0, 0]


def test_split_label(spark):
    df = spark.createDataFrame([("/x/PEDAGANG BESAR_KOTA_A.xlsx",), ("/x/y/MATARAM.csv",)], "v string")
    market, city = text.split_label(text.file_label(F.col("v")))
    assert [tuple(r) for r in df.select(market, city).collect()] == [
        ("PEDAGANG BESAR", "KOTA_A"), ("TIDAK DIKETAHUI", "MATARAM"),
    ]


def test_totals_and_blank_names_are_not_regions(spark):
    df = spark.createDataFrame(
        [("Aceh", "11"), ("INDONESIA", "00"), (" ", "12"), (None, "13"), ("Bali", ""), ("Bali", None)], "n string, c string"
    )
    kept = df.where(text.is_real_region(F.col("n"), F.col("c"))).collect()
    assert [tuple(r) for r in kept] == [("Aceh", "11")]


def test_canonical_names_keep_unknown_spellings(spark):
    df = spark.createDataFrame([(" jatim ",), ("KEP. BANGKA BELITUNG",), ("West Papua",), ("Atlantis",), (None,)], "p string")
    out = cleaning.canonical_names(df, "p", REGION_ALIASES)
    assert {r.p for r in out.collect()} == {"Jawa Timur", "Bangka Belitung", "Papua Barat", "Atlantis", None}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_canonical_names_leave_a_column_named_alias_alone(spark):
    df = spark.createDataFrame([("jatim", "x", "y")], "p string, alias string, canonical string")
    assert [tuple(r) for r in cleaning.canonical_names(df, "p", REGION_ALIASES).collect()] == [("Jawa Timur", "x", "y")]


def test_names_with_quotes(spark):
    df = spark.createDataFrame([("Sapi 'A'", 0.7)], "n string, v double")
    got = df.select(text.code_by_name("n", {"Sapi 'A'": 3}), risk.band("v", ((0.5, "it's bad"),)), risk.above("v", 0.9, rest="it's ok")).first()
    assert tuple(got) == (3, "it's bad", "it's ok")


def test_density_is_unknown_without_a_herd_size(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, 0.0), (5.0, 2000.0)], "sum_jumlah_sakit double, populasi_ternak double")
    assert [r.disease_density for r in rollups.disease_density(df).collect()] == [None, 5000.0, 2.5]


def test_series_of_unknown_sums_is_zero(spark):
    df = spark.createDataFrame([("Sapi", 2024, 1, None, None)], "nama_komoditas string, tahun int, bulan int, sum_realisasi_karkas double, avg_konsumsi_bulanan double")
    row = rollups.supply_demand_series(df, "Sapi").first()
    assert (row.sum_realisasi_karkas, row.avg_konsumsi_bulanan) == (0.0, 0.0)


def test_fixed_tables_agree():
    names = set(REGION_ALIASES.values())
    assert len(names) == 38
    assert names == set(REGION_CODES)
    assert {name for name, _, _ in REGION_CENTRES} <= {name.upper() for name in names}
    assert all(name.upper() in REGION_ALIASES for name in names)


@pytest.mark.parametrize(
    ("value", "dashboard", "notebook"),
    [(0.6, "BAHAYA", "BAHAYA"), (0.5, "WASPADA", "BAHAYA"), (0.3, "WASPADA", "WASPADA"), (0.29, "AMAN", "AMAN"), (None, "AMAN", "AMAN")],
)
def test_bands(spark, value, dashboard, notebook):
    row = spark.createDataFrame([(value,)], "v double").select(
        risk.band("v"), risk.band("v", risk.NOTEBOOK_BANDS), risk.above("v", 0.3)
    ).first()
    assert tuple(row) == (dashboard, notebook, "BAHAYA" if (value or 0) > 0.3 else "AMAN")


def test_components_are_zero_without_their_denominator(spark):
    df = spark.createDataFrame(
        [(None, 10.0, 0.0, 5.0), (12.0, None, None, None), (12.0, 0.0, -1.0, 0.0), (15.0, 10.0, 100.0, 50.0)],
        "price double, base double, herd double, demand double",
    ).withColumns({"sick": F.lit(2.0), "dead": F.lit(1.0), "moved": F.lit(5.0)})
    got = df.select(
        risk.price_gap("price", "base"), risk.health_impact("sick", "dead", "herd"), risk.supply_strain("moved", "demand")
    ).collect()
    rounded = [tuple(round(x, 6) for x in r) for r in got]
    assert rounded == [(0.0, 0.0, 1.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0), (0.5, 0.03, 0.1)]


def test_null_component_does_not_score_as_highest(spark):
    df = spark.createDataFrame([(None,), (5.0,)], "v double")
    got = df.select(risk.min_max("v", "0D", "10D")).collect()
    assert [r[0] for r in got] == [None, 0.5]


def test_monthly_rates(spark):
    df = spark.createDataFrame(
        [(1, 100, 2.0), (2, 100, 2.0), (1, None, 2.0), (1, 0, 2.0)], "id_komoditas int, jumlah_penduduk bigint, konsumsi_daging double"
    ).withColumns({c: F.lit(12.0) for c in ("populasi", "produksi_daging", "permintaan_daging", "jumlah_ternak_potong")})
    got = cleaning.monthly_rates(df).select("avg_produksi_bulanan", "avg_konsumsi_bulanan").collect()
    assert [tuple(round(x, 6) for x in r) for r in got] == [
        (1000.0, 16.666667), (1.0, 16.666667), (1000.0, 0.166667), (1000.0, 0.166667),
    ]
