"""Payloads, price sheets and small joins."""

import json

import pytest
from pyspark.sql import functions as F

from lumbung.operators import conform, measures, ranking, reshape, rollups
from lumbung.session import sizing, stage, stage_path
from lumbung.sources import indicators, readers, sinks
from lumbung.sources.fixed_values import REGION_ALIASES
from lumbung.sources.literals import literal_table


def payload(status="OK", label="Populasi Sapi Potong (ekor)", rows=()):
    table = {
        "kolom": {"a1": {"nama_variabel": "Populasi Sapi Perah"}, "b2": {"nama_variabel": label}},
        "data": [{"label": n, "kode_wilayah": k, "variables": {"b2": {"value_raw": v}} if v is not None else {}} for n, k, v in rows],
    }
    return json.dumps({"status": status, "data": [{"page": 1}, table]})


ROWS = [("Aceh ", "1100000", "435.376"), ("INDONESIA", "0000000", "9"), ("", "1", "2"), ("Bali", "", "3"), ("Riau", "1400000", None)]
WORDS = ["populasi", "sapi", "potong"]


def test_parse_indicator(spark):
    df = spark.createDataFrame(
        [(2020, payload(rows=ROWS)), (2021, payload("ERROR", rows=ROWS)), (2022, payload(label="Harga", rows=ROWS)), (2023, "not json"), (2024, None)],
        "tahun int, payload string",
    )
    got = {tuple(r) for r in indicators.parse_indicator(df, WORDS, "populasi_sapi").collect()}
    assert got == {("Aceh", 2020, "435.376"), ("Riau", 2020, None)}


def test_parse_region_indicator(spark):
    rows = [("Kabupaten A", "1101", "1"), ("aceh", "1100000", "7"), ("Aceh", "x", "8")]
    df = spark.createDataFrame([("Aceh", 2020, payload(rows=rows)), ("Bali", 2020, payload(rows=rows))], "provinsi string, tahun int, payload string")
    got = indicators.parse_region_indicator(df, WORDS, "v").collect()
    assert [tuple(r) for r in got] == [(2020, "Aceh", "1100000", "7")]


def test_first_valid_payload_follows_the_order(spark):
    good, other = payload(rows=ROWS), payload(rows=ROWS[:1])
    df = spark.createDataFrame(
        [(2020, 1, payload("ERROR")), (2020, 2, payload(label="Harga")), (2020, 3, good), (2020, 4, other), (2021, 1, other)],
        "tahun int, urutan int, payload string",
    )
    got = {r.tahun: r.payload for r in indicators.first_valid_payload(df, WORDS).collect()}
    assert got == {2020: good, 2021: other}


def test_price_sheets_from_files(spark):
    folder = stage_path(spark, "sheets")
    for path, rows in {
        "BALI/PASAR MODERN_DENPASAR": [(1, "Daging Sapi", "120000", "-"), (2, "Beras", "1", "2"), (3, "Ayam Ras", "30000", None)],
        "BALI/GIANYAR": [(1, " sapi lokal", "90000", "91000")],
    }.items():
        text = "No,Komoditas (Rp),02/ 01/ 2024,03/ 01/ 2024\n" + "\n".join(",".join("" if v is None else str(v) for v in r) for r in rows)
        fs = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{path}.csv")
        out = fs.getFileSystem(spark._jsc.hadoopConfiguration()).create(fs)
        out.write(bytearray(text.encode()))
        out.close()
    got = {
        (r.provinsi, r.kota, r.jenis_daging, r.jenis_pasar, r.harga, r.waktu.strftime("%Y-%m-%d"))
        for r in readers.read_price_sheets(spark, folder).collect()
    }
    assert got == {
        ("BALI", "DENPASAR", "Daging Sapi", "PASAR MODERN", 120000.0, "2024-01-02"),
        ("BALI", "DENPASAR", "Daging Sapi", "PASAR MODERN", None, "2024-01-03"),
        ("BALI", "DENPASAR", "Ayam Ras", "PASAR MODERN", 30000.0, "2024-01-02"),
        ("BALI", "DENPASAR", "Ayam Ras", "PASAR MODERN", None, "2024-01-03"),
        ("BALI", "GIANYAR", "sapi lokal", "TIDAK DIKETAHUI", 90000.0, "2024-01-02"),
        ("BALI", "GIANYAR", "sapi lokal", "TIDAK DIKETAHUI", 91000.0, "2024-01-03"),
    }


def test_sheet_without_named_label_or_dates(spark):
    df = spark.createDataFrame([(1, "Sapi", 5.0)], "no int, nama string, `1-2-2024` double")
    lit = F.lit("x")
    row = readers.unpivot_price_sheet(df, lit, lit, lit).first()
    assert (row.jenis_daging, row.harga, str(row.waktu)) == ("Sapi", 5.0, "2024-02-01 00:00:00")
    with pytest.raises(ValueError):
        readers.unpivot_price_sheet(df.select("no", "nama"), lit, lit, lit)


def test_sheet_without_words_keeps_all_but_repeated_headers(spark):
    df = spark.createDataFrame([(1, "Beras", 5.0), (2, "Komoditas (Rp)", 6.0)], "no int, `Komoditas (Rp)` string, `01/02/2024` double")
    lit = F.lit("x")
    assert [r.jenis_daging for r in readers.unpivot_price_sheet(df, lit, lit, lit, ()).collect()] == ["Beras"]


def test_pivot_and_unpivot_round_trip(spark):
    long = spark.createDataFrame([("a", "2024/01", 1.0), ("a", "2024/02", 2.0), ("b", "2024/01", 3.0)], "k string, p string, v double")
    wide = reshape.heatmap(long, "k", F.col("p"), "v", ["2024/01", "2024/02"])
    back = reshape.longer(wide, ["k"], ["2024/01", "2024/02"], "p", "v").where("v IS NOT NULL")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in long.collect()}


def test_snapshot_reports_the_failed_table(spark):
    good = spark.range(3)
    bad = spark.range(1).select(F.raise_error(F.lit("broken")).alias("x"))
    outcome = sinks.snapshot({"good": good, "bad": bad, "also": good}, stage_path(spark, "snap"))
    assert outcome["good"] is None and outcome["also"] is None and "broken" in str(outcome["bad"])


def test_reconcile_regions_by_name_and_by_id(spark):
    left = spark.createDataFrame([(1, "Aceh"), (2, "Bali")], "id_wilayah int, provinsi string")
    right = spark.createDataFrame([(1, " BALI"), (2, "Riau")], "id_wilayah int, provinsi string")
    by_name = {tuple(r) for r in conform.reconcile_regions(left, right).collect()}
    assert by_name == {(1, "Aceh"), (2, "Bali"), (2, "Riau")}
    same_id = F.col("l.id_wilayah") == F.col("r.id_wilayah")
    assert {tuple(r) for r in conform.reconcile_regions(left, right, same_id).collect()} == {(1, "Aceh"), (2, "Bali")}


def test_map_join_uses_one_alias_table_on_both_sides(spark):
    shapes = spark.createDataFrame([("West Java",), ("Bangka-Belitung",), ("Bali",)], "provinsi string")
    metrics = spark.createDataFrame([("JAWA BARAT", 0.4), ("KEP. BANGKA BELITUNG", 0.7)], "nama_provinsi string, v double")
    got = {(r.provinsi, r.v) for r in conform.map_join(shapes, metrics, REGION_ALIASES).collect()}
    assert got == {("West Java", 0.4), ("Bangka-Belitung", 0.7), ("Bali", None)}


def test_centre_join_clamps_the_radius(spark):
    centres = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0), ("c", 1.0, 2.0), ("d", 1.0, 2.0)], "nama_provinsi string, lat double, lon double")
    metrics = spark.createDataFrame([("A", 0.05), ("B", 0.5), ("C", 0.9), ("D", None)], "nama_provinsi string, supply_risk_index double")
    assert {(r.nama_provinsi, r.radius) for r in conform.centre_join(centres, metrics).collect()} == {("A", 6.0), ("B", 20.0), ("C", 30.0)}


def test_merge_measures_is_a_full_join_without_null_keys(spark):
    keys = "id_wilayah int, bulan int, tahun int, id_komoditas int"
    a = spark.createDataFrame([(1, 1, 2024, 1, 5.0), (2, 1, 2024, 1, None), (3, None, None, 1, 9.0)], f"{keys}, a double")
    b = spark.createDataFrame([(1, 1, 2024, 1, 7.0), (1, 2, 2024, 1, 8.0)], f"{keys}, b double")
    got = {(r.id_wilayah, r.bulan, r.a, r.b) for r in measures.merge_measures([a, b]).collect()}
    assert got == {(1, 1, 5.0, 7.0), (2, 1, None, None), (1, 2, None, 8.0)}


def test_default_selection(spark):
    available = spark.createDataFrame([(c,) for c in "dbcae"], "p string")
    some = spark.createDataFrame([("e",), ("z",)], "p string")
    none = spark.createDataFrame([("z",)], "p string")
    assert [r.p for r in ranking.default_selection(available, some).collect()] == ["e"]
    assert sorted(r.p for r in ranking.default_selection(available, none).collect()) == ["a", "b", "c"]


def test_latest_rows_are_per_group(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 2, 3.0), ("b", 1, 4.0)], "g string, t int, v double")
    assert sorted(r.v for r in rollups.latest_rows(df, "g", "t").collect()) == [2.0, 3.0, 4.0]


def test_one_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 9), (2, "x", 1)], "k int, v string, o int")
    got = {(r.k, r.v) for r in reshape.one_per_key(df, ["k"], [F.col("o"), F.col("v")]).collect()}
    assert got == {(1, "a"), (2, "x")}


def test_session_sizing():
    small, large = sizing(1 << 30), sizing(100 << 40)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert small == {key: "200"}
    assert large == {key: str(100 << 10)}


def test_literal_table_quotes_text(spark):
    rows = [("it's", 1, 2.5), ("a\\b", None, None)]
    assert [tuple(r) for r in literal_table(spark, ["s", "i", "d"], rows).collect()] == rows


def test_csv_cells(spark):
    lines = ["a,b", ",x,", '"1, ""2""",,"",z', "", '"open,1', 'a"b,c']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r.c for r in df.select(readers.csv_cells(F.col("line")).alias("c")).collect()]
    assert got == [["a", "b"], [None, "x", None], ['1, "2"', None, None, "z"], [None], ['"open', "1"], ['a"b', "c"]]


def test_sheets_with_different_headers(spark, tmp_path):
    """Each file has its own days, label column and order; all are read in one scan."""
    sheets = {
        "pulau/Jawa Timur/PASAR_SURABAYA.csv": '﻿No,Komoditas (Rp),01/ 01/ 2024,02/ 01/ 2024,note\r\n1," Daging Sapi, murni ",100,-,x\r\n2,Beras,5,6,\r\n\r\n',
        "Bali/MODERN_DENPASAR.csv": "No,Nama,05-02-2024\nI,daging ayam,31000\nII,Daging sapi\n",
        "Aceh/TOKO.csv": "Komoditas,No,1/3/2024,2/3/2024\nAyam ras,1,\"1,5\",7\nKomoditas (Rp),2,1,1",
        "Papua/KOSONG_KOTA.csv": "No,Komoditas,lain\n1,daging sapi,3\n",
        "Papua/SATU_BARIS.csv": "No,Komoditas,01/01/2024\n",
        "Papua/NIHIL_X.csv": "",
    }
    for name, text in sheets.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    df = readers.read_mixed_price_sheets(spark, str(tmp_path), ["daging", "ayam"])
    got = {(r.provinsi, r.jenis_pasar, r.kota, r.jenis_daging, r.harga, str(r.waktu)[:10]) for r in df.collect()}
    assert got == {
        ("JAWA TIMUR", "PASAR", "SURABAYA", "Daging Sapi, murni", 100.0, "2024-01-01"), ("JAWA TIMUR", "PASAR", "SURABAYA", "Daging Sapi, murni", None, "2024-01-02"),
        ("BALI", "MODERN", "DENPASAR", "daging ayam", 31000.0, "2024-02-05"), ("BALI", "MODERN", "DENPASAR", "Daging sapi", None, "2024-02-05"),
        ("ACEH", "TIDAK DIKETAHUI", "TOKO", "Ayam ras", None, "2024-03-01"), ("ACEH", "TIDAK DIKETAHUI", "TOKO", "Ayam ras", 7.0, "2024-03-02"),
    }
    assert df.columns == list(readers.PRICE_COLUMNS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    every = readers.read_mixed_price_sheets(spark, str(tmp_path), [])
    assert {r.jenis_daging for r in every.collect()} == {"Daging Sapi, murni", "Beras", "daging ayam", "Daging sapi", "Ayam ras"}


def test_documents_are_parsed_once_for_all_indicators(spark):
    table = {"kolom": {"v1": {"nama_variabel": "Populasi Sapi"}, "v2": {"nama_variabel": "Populasi AYAM"}}, "data": [
        {"label": " Aceh ", "kode_wilayah": "11", "variables": {"v1": {"value_raw": "5"}, "v2": {"value_raw": "7"}}},
        {"label": "Indonesia", "kode_wilayah": "0", "variables": {"v1": {"value_raw": "9"}}},
    ]}
    good = json.dumps({"status": "OK", "data": [{"page": 1}, table]})
    rows = [(c, 2024, u, p) for c in ("sapi", "ayam", "other", "none") for u, p in ((1, '{"status": "ERROR"}'), (2, "broken"), (3, None), (4, good), (5, good.replace('"5"', '"6"')))]
    df = stage(spark.createDataFrame(rows, "indikator string, tahun int, urutan int, payload string"), "documents")
    words = {"sapi": ["populasi", "SAPI"], "ayam": ["populasi", "ayam"], "none": ["kerbau"]}
    out = indicators.annual_statistics(df, words)
    assert [tuple(r) for r in out.collect()] == [("Aceh", 2024, "5", "7", None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and plan.count("from_json") == 1
