"""The whole job on hand-written staging tables."""

import json

import pytest
from pyspark.sql import functions as F

from lumbung.operators import quality, rollups, star
from lumbung.plans import daily, result_sets, standin, standin_staging
from lumbung.plans.warehouse import build_warehouse, cube_of, load_warehouse
from lumbung.session import stage, stage_path
from lumbung.sources import readers, sinks
from lumbung.sources.fixed_values import INDICATORS

DUMMY = [
    "populasi_sapi", "populasi_ayam", "produksi_daging_sapi", "produksi_daging_ayam", "konsumsi_daging_sapi", "konsumsi_daging_ayam",
    "permintaan_daging_sapi", "permintaan_daging_ayam", "jumlah_ternak_sapi_potong", "jumlah_ternak_ayam_potong",
    "harga_baseline_sapi", "harga_baseline_ayam", "growth_populasi",
]


def staging(spark):
    """Three regions that the sources spell and number differently."""
    api = [
        ("Aceh", "2024", "1.000,5", "200", "5.000", "1.200"), ("Aceh", "2025", "1.100", None, "5.100", "1.250"),
        ("Kepulauan Bangka Belitung", "2024", "300", "90", "-", "400"), ("Kepulauan Bangka Belitung", "2025", "310", "95", "800", "-"),
        ("Jawa Timur", "2024", "9.000", "4.000", "70.000", "9.999,5"), ("Jawa Timur", "2025", "9.100", "4.100", "71.000", "10.000"),
        ("Bali", "2024", "500", "80", "900", "100"),
    ]
    measures = {
        "Aceh": (210, 5200, 12.0, 1300.0, 2.0, 9.0, 2400.0, 6000.0, 120, 2400, 100000, 25000, 0.01),
        "Bangka Belitung": (91, 700, None, 420.0, 1.5, 8.0, 600.0, 1800.0, 60, 600, 110000, None, 0.02),
        "Jawa Timur": (3900, 69000, 240.0, 9900.0, 2.5, 10.0, 24000.0, 36000.0, 1200, 36000, 105000, 24000, 0.03),
    }
    dummy = [(p, y, *[None if v is None else float(v) for v in m]) for p, m in measures.items() for y in (2024, 2025)]
    # Another year of the same region gives the mean for the missing production.
    dummy = [
        (p, y, *(m[:2] + (6.0,) + m[3:] if p == "Bangka Belitung" and y == 2025 else m)) for p, y, *m in ((r[0], r[1], *r[2:]) for r in dummy)
        for m in [tuple(m)]
    ]
    return {
        "bps_api_raw": spark.createDataFrame(api, "provinsi string, tahun string, jumlah_penduduk string, populasi_sapi string, populasi_ayam string, produksi_daging_ayam string"),
        "bps_dummy_raw": spark.createDataFrame(dummy, "provinsi string, tahun int, " + ", ".join(f"{c}_dummy double" for c in DUMMY)),
        "ref_hewan": spark.createDataFrame([("H4", "Sapi", "x"), ("H2", "AYAM", "y"), ("H9", "Kambing", "x")], "id_hewan string, nama_hewan string, kategori string"),
        "ref_wilayah": spark.createDataFrame([(1, "JATIM"), (2, "Aceh"), (3, "Babel"), (4, "Papua")], "id_wilayah int, provinsi string"),
        "tr_mutasi": spark.createDataFrame(
            [("M1", "03/16/24", 1, 2, "H4", 100.0), ("M2", "03/20/2024", 1, 3, "H4", 50.0), ("M3", "03/01/24", 2, 1, "H2", None),
             ("M4", "bad", 1, 2, "H4", 999.0), ("M5", "04/01/24", 1, 2, "H9", 77.0), ("M6", "04/02/24", 4, 1, "H4", 5.0)],
            "id_mutasi string, tgl_mutasi string, id_asal int, id_tujuan int, id_hewan string, jumlah_ekor double",
        ),
        "tr_laporan_sakit": spark.createDataFrame(
            [("L1", "03/05/24", 1, "H4", 10.0, 2.0), ("L2", "03/06/24", 1, "H4", None, 1.0), ("L3", "05/05/24", 3, "H2", 7.0, None)],
            "id_laporan string, tgl_lapor string, id_wilayah int, id_hewan string, jumlah_gejala double, jumlah_mati double",
        ),
        "tr_rph": spark.createDataFrame(
            [("R1", "03/07/24", 1, "H4", 40.5), ("R2", "01/07/25", 2, "H2", 9.5)],
            "id_potong string, tgl_potong string, id_wilayah int, id_hewan string, berat_karkas double",
        ),
        "pihps_raw": spark.createDataFrame(
            [("jatim", "Daging Sapi Kualitas 1", "120000", "2024-03-01 00:00:00"), ("JAWA TIMUR", "daging sapi", "130000", "2024-03-02 00:00:00"),
             ("JAWA TIMUR", "daging sapi", "-", "2024-03-03 00:00:00"), ("JAWA TIMUR", "daging sapi", "110000", "2025-03-03 00:00:00"),
             ("aceh", "Ayam Ras", "30000", "2024-02-01 00:00:00"), ("Atlantis", "Ayam Ras", "1", "2024-02-01 00:00:00"),
             ("aceh", "Daging Kambing", "5", "2024-02-01 00:00:00")],
            "provinsi string, nama_komoditas string, harga string, waktu string",
        ),
    }


@pytest.fixture(scope="module")
def tables(spark):
    return build_warehouse(staging(spark))


@pytest.fixture(scope="module")
def facts(tables):
    return {(r.nama_provinsi, r.nama_komoditas, r.tahun, r.bulan): r for r in cube_of(tables).collect()}


def test_regions_are_matched_by_name(tables):
    assert [r.nama_provinsi for r in tables["dim_prov"].orderBy("prov_key").collect()] == ["Aceh", "Bangka Belitung", "Jawa Timur", "Papua"]


def test_months_span_the_statistics(tables):
    rows = tables["dim_waktu"].orderBy("waktu_key").collect()
    assert len(rows) == 24 and (rows[0].tahun, rows[0].bulan, rows[0].kuartal, rows[0].nama_bulan) == (2024, 1, 1, "Januari")
    assert (rows[-1].waktu_key, rows[-1].tahun, rows[-1].bulan) == (24, 2025, 12)


def test_fact_rows(facts):
    """Only region-months with an event or a price, a known commodity and an annual row."""
    assert set(facts) == {
        ("Jawa Timur", "Sapi", 2024, 3), ("Jawa Timur", "Sapi", 2025, 3), ("Aceh", "Ayam", 2024, 2), ("Aceh", "Ayam", 2024, 3),
        ("Aceh", "Ayam", 2025, 1), ("Bangka Belitung", "Ayam", 2024, 5),
    }


def test_sums_and_prices(facts):
    east = facts[("Jawa Timur", "Sapi", 2024, 3)]
    assert (east.sum_jumlah_sakit, east.sum_jumlah_mati, east.sum_vol_mutasi, east.sum_realisasi_karkas) == (10.0, 3.0, 150.0, 40.5)
    # The missing price takes the median of all March prices (110000, 120000, 130000).
    assert east.avg_harga == pytest.approx((120000 + 130000 + 120000) / 3, abs=0.01)
    aceh = facts[("Aceh", "Ayam", 2024, 3)]
    assert (aceh.sum_vol_mutasi, aceh.sum_jumlah_sakit) == (0.0, 0.0)
    assert aceh.avg_harga == 30000.0  # February's price
    assert facts[("Bangka Belitung", "Ayam", 2024, 5)].avg_harga == 30000.0  # the commodity's median


def test_annual_values(facts):
    east = facts[("Jawa Timur", "Sapi", 2024, 3)]
    assert east.jumlah_penduduk == 9000 and east.populasi_ternak == 4000.0 and east.harga_baseline == 105000.0
    assert east.avg_produksi_bulanan == 20000.0  # 240 tonnes
    assert east.avg_konsumsi_bulanan == 1875.0  # 2.5 kg for each of 9000
    assert east.avg_permintaan_bulanan == 2000.0 and east.avg_pemotongan_bulanan == 100.0
    aceh = facts[("Aceh", "Ayam", 2024, 2)]
    assert aceh.jumlah_penduduk == 1000  # truncated
    assert aceh.avg_produksi_bulanan == 100.0
    islands = facts[("Bangka Belitung", "Ayam", 2024, 5)]
    assert islands.populasi_ternak == 700.0  # the substitute source
    assert islands.harga_baseline is None  # baselines are not imputed


def test_index(facts):
    raw = {}
    for key, r in facts.items():
        gap = (r.avg_harga - r.harga_baseline) / r.harga_baseline if r.harga_baseline else 0.0
        raw[key] = (gap, (r.sum_jumlah_sakit + r.sum_jumlah_mati) / r.populasi_ternak, r.sum_vol_mutasi / r.avg_permintaan_bulanan)
    lows, highs = [min(c) for c in zip(*raw.values())], [max(c) for c in zip(*raw.values())]
    for key, parts in raw.items():
        expected = sum((p - lo) / (hi - lo) for p, lo, hi in zip(parts, lows, highs)) / 3
        assert facts[key].supply_risk_index == pytest.approx(expected, abs=2e-6)


def test_mean_fill_of_statistics(tables):
    rows = tables["tr_statistik"].join(tables["dim_prov"], F.expr("id_prov = id_wilayah")).where(
        "nama_provinsi = 'Bangka Belitung' AND id_komoditas = 1"
    ).collect()
    assert {(r.tahun, r.produksi_daging) for r in rows} == {(2024, 6.0), (2025, 6.0)}


def test_ordinal_mode_takes_ids_as_ranks(spark):
    """Event region 1 is Jawa Timur by name, but the first name of the statistics is Aceh."""
    tables = build_warehouse(staging(spark), key_mode="ordinal", years=(2020, 2025))
    rows = {(r.nama_provinsi, r.tahun, r.bulan): r for r in cube_of(tables).where("nama_komoditas = 'Sapi'").collect()}
    assert rows[("Aceh", 2024, 3)].sum_vol_mutasi == 150.0
    assert rows[("Jawa Timur", 2024, 3)].sum_vol_mutasi == 0.0
    assert tables["dim_waktu"].count() == 72


def test_load_and_read_back(spark, tables):
    folder = stage_path(spark, "dwh")
    loaded = load_warehouse(tables, folder)
    assert loaded[sinks.FACT].columns == list(star.FACT_TYPES)
    assert readers.read_parquet(spark, folder, sinks.FACT).count() == 6
    again = load_warehouse(loaded | {sinks.FACT: tables[sinks.FACT]}, stage_path(spark, "dwh"))
    assert again[sinks.FACT].count() == 6
    with pytest.raises(readers.TableNotFound):
        readers.read_parquet(spark, folder, "missing")


def test_save_parquet_partitions_the_fact(spark, tables):
    folder = stage_path(spark, "output")
    fact = tables[sinks.FACT].join(tables["dim_waktu"].select("waktu_key", "tahun"), "waktu_key")
    sinks.save_parquet({**tables, sinks.FACT: fact}, folder)
    back = sinks.read_back(spark, folder, [*tables])
    assert {name: df.count() for name, df in back.items()} == {name: df.count() for name, df in tables.items()}
    plan = back[sinks.FACT].where("tahun = 2025")
    assert plan.count() == 2 and "PartitionFilters: [isnotnull(tahun" in plan._jdf.queryExecution().executedPlan().toString()


def test_gate_stops_a_bad_load(spark, tables):
    bad = tables[sinks.FACT].withColumn("prov_key", F.when(F.col("komoditas_key") == 1, 99).otherwise(F.col("prov_key")))
    with pytest.raises(quality.QualityError, match="orphan_key fact_supply_resilience.prov_key: 1"):
        load_warehouse({**tables, sinks.FACT: bad}, stage_path(spark, "dwh"))
    nulls = tables[sinks.FACT].withColumn("waktu_key", F.lit(None).cast("int"))
    with pytest.raises(quality.QualityError, match="null_key fact_supply_resilience.waktu_key: 6"):
        load_warehouse({**tables, sinks.FACT: nulls}, stage_path(spark, "dwh"))
    twice = tables[sinks.FACT].unionByName(tables[sinks.FACT])
    with pytest.raises(quality.QualityError, match="unique"):
        load_warehouse({**tables, sinks.FACT: twice}, stage_path(spark, "dwh"))


def test_missing_column_is_reported_with_all_rows(tables):
    report = quality.required_columns("dim_prov", tables["dim_prov"].drop("nama_provinsi"), ["prov_key", "nama_provinsi"])
    assert {(r.column_name, r.bad_rows) for r in report.collect()} == {("prov_key", 0), ("nama_provinsi", 4)}


def test_cube_csv_round_trip(spark, tables):
    path = stage_path(spark, "csv")
    cube = cube_of(tables)
    sinks.export_cube(cube, path)
    back = readers.read_cube_csv(spark, path)
    want = {tuple(r) for r in cube.withColumn("nama_provinsi", F.upper("nama_provinsi")).collect()}
    assert {tuple(r) for r in back.collect()} == want


def test_pareto_ends_at_one_hundred(tables):
    rows = rollups.supply_concentration(cube_of(tables)).orderBy("cumsum_pct").collect()
    assert rows[-1].cumsum_pct == pytest.approx(100.0)
    empty = rollups.supply_concentration(cube_of(tables).withColumn("sum_vol_mutasi", F.lit(0.0))).collect()
    assert all(r.pct is None for r in empty)


def test_dashboard_and_notebook(spark, tables):
    cube = stage(cube_of(tables).withColumn("nama_provinsi", F.upper("nama_provinsi")), "cube")
    sets = result_sets.dashboard(cube, map_year=2024, upstream=("JAWA TIMUR",), downstream=("JAWA TIMUR",))
    counts = {name: df.count() for name, df in sets.items()}
    assert counts["kpi"] == counts["gap_tiles"] == 1
    assert counts["latest_status"] == counts["map"] == counts["map_bubbles"] == counts["pareto"] == 3
    assert counts["top_timeline"] == 6 and counts["risk_heatmap"] == 3 and counts["regions"] == 3
    assert counts["lag_scan"] == 0 and counts["lag_overlay"] == 2
    east = sets["latest_status"].where("nama_provinsi = 'JAWA TIMUR'").first()
    assert (east.sakit, east.avg_harga) == (0.0, 110000.0)
    plain = result_sets.dashboard(stage(cube_of(tables), "cube"), upstream=("Jawa Timur",), downstream=("jawa timur",))
    assert plain["lag_overlay"].count() == 2  # names as the warehouse has them
    newest = {r.nama_provinsi: r.sum_vol_mutasi for r in plain["map"].collect()}
    every = {r.nama_provinsi: r.sum_vol_mutasi for r in result_sets.dashboard(cube, map_year="Semua")["map"].collect()}
    assert newest == {r.nama_provinsi: r.v for r in cube_of(tables).where("tahun = 2025").groupBy("nama_provinsi").agg(F.sum("sum_vol_mutasi").alias("v")).collect()}
    assert set(map(str.upper, newest)) <= set(every)
    filtered = result_sets.dashboard(cube, commodity="Ayam", year=2024, region="ACEH")
    assert filtered["monthly_gap"].count() == 2 and filtered["price_heatmap"].columns[1:] == ["2024/02", "2024/03", "2024/05", "2025/01", "2025/03"]
    book = result_sets.notebook(cube)
    summary = book["summary"].first()
    assert summary.top_share == pytest.approx(100.0)
    assert {name: df.count() for name, df in book.items()}["pareto"] == 3


def test_daily_run(spark):
    """Documents and tables in, loaded star and cube file out; the same rows as the direct build."""
    tables = staging(spark)
    api = tables["bps_api_raw"].collect()
    documents = []
    for column, words in INDICATORS.items():
        for year in ("2024", "2025"):
            rows = [{"label": r.provinsi, "kode_wilayah": "1", "variables": {"v": {"value_raw": r[column]}}} for r in api if r.tahun == year]
            table = {"kolom": {"v": {"nama_variabel": " ".join(words)}}, "data": rows}
            documents.append((column, int(year), 1, json.dumps({"status": "ERROR"})))
            documents.append((column, int(year), 2, json.dumps({"status": "OK", "data": [{}, table]})))
    payloads = spark.createDataFrame(documents, "indikator string, tahun int, urutan int, payload string")
    lab = spark.createDataFrame([("U1", "L1", "03/09/24", "PMK", None)], "id_uji string, id_laporan string, tgl_uji string, penyakit string, hasil_uji string")
    prices = tables["pihps_raw"].select(
        "provinsi", "nama_komoditas", F.expr("try_cast(harga AS double) AS harga"), F.expr("cast(waktu AS timestamp_ntz) AS waktu")
    )
    substitute = tables["bps_dummy_raw"].withColumn("jumlah_penduduk_dummy", F.lit(None).cast("double"))
    folder = stage_path(spark, "daily")
    counts = daily.extract(f"{folder}/staging", payloads, substitute, {**tables, "tr_hasil_lab": lab}, prices)
    assert {r.table_name: r.n_rows for r in counts.collect()}["bps_api_raw"] == 7
    loaded = daily.run_daily(spark, f"{folder}/staging", f"{folder}/output", f"{folder}/dwh", f"{folder}/cube")
    direct = build_warehouse(tables)
    want = {tuple(r) for r in star.align(direct[sinks.FACT]).collect()}
    assert {tuple(r) for r in loaded[sinks.FACT].collect()} == want
    assert readers.read_cube_csv(spark, f"{folder}/cube").count() == 6
    with pytest.raises(RuntimeError):
        daily.extract(f"{folder}/bad", payloads, substitute.select(F.raise_error(F.lit("x")).alias("x")), {**tables, "tr_hasil_lab": lab}, prices)


def test_staging_tables_derive_from_lines_that_are_joined_once(spark):
    """None of the staging tables reads the order lines again, and all have their rows."""
    day = "timestamp_ntz'2024-03-05 00:00:00'"
    rows = {
        "nation": "select 1 n_nationkey, 'JAVA' n_name, 0 n_regionkey",
        "supplier": "select 7L s_suppkey, 's' s_name, 1 s_nationkey, 0D s_acctbal",
        "part": "select col1 p_partkey, 'p' p_name, 'b' p_brand, col2 p_type, 1 p_size, 10D p_retailprice from values (1L, 'SMALL'), (2L, 'PROMO')",
        "orders": f"select col1 o_orderkey, 1L o_custkey, 'O' o_orderstatus, 1D o_totalprice, {day} o_orderdate, '1' o_orderpriority from values (5L), (20L)",
        "lineitem": "select col1 l_orderkey, col2 l_partkey, 7L l_suppkey, col3 l_linenumber, 4D l_quantity, 8D l_extendedprice, 0D l_discount, 0D l_tax, "
                    "col4 l_returnflag, 'F' l_linestatus, timestamp_ntz'2024-04-01 00:00:00' l_shipdate "
                    "from values (5L, 1L, 1, 'R'), (5L, 2L, 2, 'N'), (20L, 1L, 1, 'N'), (20L, 1L, 2, 'R')",
    }
    t = standin.Source(spark, "")
    t._tables = {name: stage(spark.sql(sql), name) for name, sql in rows.items()}
    tables = standin_staging.staging(t)
    lines = set(t("lineitem").inputFiles())
    assert lines and not [name for name, df in tables.items() if lines & set(df.inputFiles())]
    assert {n: tables[n].count() for n in ("tr_mutasi", "tr_laporan_sakit", "tr_rph", "pihps_raw", "bps_api_raw", "bps_dummy_raw")} == {
        "tr_mutasi": 4, "tr_laporan_sakit": 2, "tr_rph": 2, "pihps_raw": 3, "bps_api_raw": 1, "bps_dummy_raw": 1
    }
    assert sorted(str(r["harga"]) for r in tables["pihps_raw"].collect()) == ["2.0", "None", "None"]
