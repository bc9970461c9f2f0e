"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.operators import measures, quality, ranking, rollups
from lumbung.operators.imputation import fill_price_gaps
from lumbung.operators.index import with_components
from lumbung.operators.quantiles import exact_median, exact_quantiles, grouped_quantiles
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.session import stage
from lumbung.workload.base import (
    ANNUAL, CUBE, FACT, INTEGRATED, SCALED, TEST_BANDS, band_sql, n, on_cube, on_lines, query, r, tidy,
)

MONTH_KEYS = ["id_asal", "bulan", "tahun", "id_komoditas"]


@query("e1_sick_dead_sums", on_lines("""
SELECT id_asal, bulan, tahun, id_komoditas, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS sum_jumlah_sakit,
       sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity END) AS sum_jumlah_mati
FROM lines GROUP BY ALL"""))
def sick_dead_sums(t: Source) -> DataFrame:
    return measures.sums_by(standin.lines(t), MONTH_KEYS, {
        "sum_jumlah_sakit": F.expr(standin.RETURNED), "sum_jumlah_mati": F.expr(standin.RETURNED_FINISHED)
    })


@query("e2_movement_volume", on_lines("""
SELECT id_asal, bulan, tahun, id_komoditas, sum(l_quantity) AS sum_vol_mutasi FROM lines GROUP BY ALL"""))
def movement_volume(t: Source) -> DataFrame:
    return measures.sums_by(standin.lines(t), MONTH_KEYS, {"sum_vol_mutasi": F.col("l_quantity")})


@query("e3_carcass_weight", on_lines(f"""
SELECT id_asal, bulan, tahun, id_komoditas, {r("sum(l_extendedprice * (1 - l_discount))", 2)} AS sum_realisasi_karkas
FROM lines GROUP BY ALL"""))
def carcass_weight(t: Source) -> DataFrame:
    out = measures.sums_by(standin.lines(t), MONTH_KEYS, {"sum_realisasi_karkas": F.expr(standin.REVENUE)})
    return tidy(out, {"sum_realisasi_karkas": 2})


@query("e4_mean_price", on_lines(f"""
SELECT CAST(n_nationkey AS INTEGER) AS id_wilayah, bulan, tahun, id_komoditas, {r("avg(l_extendedprice / l_quantity)", 4)} AS avg_harga
FROM lines JOIN nation ON n_nationkey = id_asal WHERE n_nationkey <> 8 GROUP BY ALL"""))
def mean_price(t: Source) -> DataFrame:
    prices = standin.lines(t).join(t("nation"), F.expr("n_nationkey = id_asal")).selectExpr(
        "concat(' ', lower(n_name)) AS provinsi", "bulan", "tahun", "id_komoditas AS kode", f"{standin.UNIT_PRICE} AS harga"
    )
    out = measures.monthly_price(prices, standin.region_dim(t).where("id_prov <> 8"), F.col("kode"))
    return tidy(out, {"avg_harga": 4})


@query("e5_group_median", on_lines("""
SELECT id_asal, id_komoditas, bulan, quantile_disc(l_extendedprice, 0.5) AS median_harga FROM lines GROUP BY ALL"""))
def group_median(t: Source) -> DataFrame:
    # The quantiles read their rows twice; four staged columns are cheaper than a second join.
    rows = stage(standin.lines(t).select("id_asal", "id_komoditas", "bulan", "l_extendedprice"), "prices")
    return exact_median(rows, ["id_asal", "id_komoditas", "bulan"], F.col("l_extendedprice"), "median_harga")


MEANS = ("populasi", "produksi_daging", "konsumsi_daging", "permintaan_daging", "jumlah_ternak_potong")


@query("e6_group_means", f"""WITH {ANNUAL}
SELECT id_wilayah, id_komoditas, {", ".join(f"{r(f'avg({c})', 3)} AS mean_{c}" for c in MEANS)} FROM annual GROUP BY ALL""")
def group_means(t: Source) -> DataFrame:
    stats = standin.annual(standin.flow(t))
    out = stats.groupBy("id_wilayah", "id_komoditas").agg(*[F.avg(c).alias(f"mean_{c}") for c in MEANS])
    return tidy(out, {f"mean_{c}": 3 for c in MEANS})


@query("e7_commodity_median", f"""WITH {INTEGRATED}
SELECT id_komoditas, {r("quantile_disc(avg_harga, 0.5)", 4)} AS global_median_harga FROM integrated WHERE avg_harga IS NOT NULL GROUP BY 1""")
def commodity_median(t: Source) -> DataFrame:
    monthly = standin.monthly(standin.flow(t))
    return tidy(grouped_quantiles(monthly, ["id_komoditas"], "avg_harga", {"global_median_harga": 0.5}), {"global_median_harga": 4})


RAW = ("raw_price_gap", "raw_health_impact", "raw_supply_strain")


@query("e8_global_min_max", f"""WITH {SCALED}
SELECT {", ".join(f"{r(f'{f}({c})', 6)} AS {f}_{c}" for c in RAW for f in ("min", "max"))} FROM scaled""")
def global_min_max(t: Source) -> DataFrame:
    components = with_components(fill_price_gaps(standin.staged_integrated(t)))
    out = components.agg(*[F.expr(f"{f}({c}) AS {f}_{c}") for c in RAW for f in ("min", "max")])
    return tidy(out, dict.fromkeys(out.columns, 6))


@query("e9_index_statistics", f"""WITH {FACT}
SELECT {r("min(supply_risk_index)", 6)} AS min, {r("max(supply_risk_index)", 6)} AS max, {r("avg(supply_risk_index)", 6)} AS mean,
       {r("stddev_samp(supply_risk_index)", 6)} AS std, quantile_disc(supply_risk_index, 0.5) AS median FROM fact""")
def index_statistics(t: Source) -> DataFrame:
    return rollups.index_statistics(standin.warehouse(t)["fact_supply_resilience"])


@query("e10_load_summary", f"""WITH {FACT}
SELECT (SELECT count(*) FROM dim_prov) AS n_dim_prov, (SELECT count(*) FROM dim_komoditas) AS n_dim_komoditas,
       (SELECT count(*) FROM dim_waktu) AS n_dim_waktu, (SELECT count(*) FROM fact) AS n_fact,
       {r("(SELECT min(supply_risk_index) FROM fact)", 6)} AS risk_min, {r("(SELECT max(supply_risk_index) FROM fact)", 6)} AS risk_max,
       {r("(SELECT avg(supply_risk_index) FROM fact)", 6)} AS risk_avg""")
def load_summary(t: Source) -> DataFrame:
    w = standin.warehouse(t)
    return rollups.load_summary(w["dim_prov"], w["dim_komoditas"], w["dim_waktu"], w["fact_supply_resilience"])


@query("e11_duplicate_names", "SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def duplicate_names(t: Source) -> DataFrame:
    return quality.repeated_names(t("part"), "p_name")


@query("e12_kpi_tiles", on_cube(f"""
SELECT {r("avg(supply_risk_index)", 6)} AS avg_risk, count(*) FILTER (supply_risk_index >= 0.12) AS n_bahaya,
       count(*) FILTER (supply_risk_index >= 0.06 AND supply_risk_index < 0.12) AS n_waspada,
       count(*) FILTER (supply_risk_index < 0.06) AS n_aman FROM cube"""))
def kpi_tiles(t: Source) -> DataFrame:
    return tidy(rollups.kpi_tiles(standin.cube(t), TEST_BANDS), {"avg_risk": 6})


@query("e13_zone_distribution", on_cube(f"""
SELECT {band_sql("m", 0.086, 0.084)} AS zona, count(*) AS n FROM (SELECT avg(supply_risk_index) AS m FROM cube GROUP BY nama_provinsi)
GROUP BY ALL"""))
def zone_distribution(t: Source) -> DataFrame:
    return rollups.zone_distribution(standin.cube(t), ((0.086, "BAHAYA"), (0.084, "WASPADA")))


@query("e14_quarterly_trend", on_cube(f"""
SELECT tahun, kuartal, {r("avg(supply_risk_index)", 6)} AS avg_risk, tahun || ' Q' || kuartal AS periode FROM cube GROUP BY ALL"""))
def quarterly_trend(t: Source) -> DataFrame:
    return tidy(rollups.quarterly_trend(standin.cube(t)), {"avg_risk": 6})


@query("e15_latest_status", on_cube(f"""
SELECT *, {band_sql("risk", 0.12, 0.06)} AS status FROM (
  SELECT nama_provinsi, {r("avg(supply_risk_index)", 4)} AS risk, {r("avg(avg_harga)", 0)} AS avg_harga, sum(sum_jumlah_sakit) AS sakit
  FROM (SELECT *, max(waktu_key) OVER (PARTITION BY nama_provinsi) AS terakhir FROM cube) WHERE waktu_key = terakhir GROUP BY 1)"""))
def latest_status(t: Source) -> DataFrame:
    return rollups.latest_status(standin.cube(t, staged=True), TEST_BANDS)


GAPS = """gaps AS (
  SELECT tahun, bulan, nama_komoditas, sum(sum_vol_mutasi) AS sum_vol_mutasi, avg(avg_permintaan_bulanan) AS avg_permintaan,
         sum(sum_realisasi_karkas) AS sum_karkas, avg(avg_konsumsi_bulanan) AS avg_konsumsi,
         sum(sum_vol_mutasi) - avg(avg_permintaan_bulanan) AS gap_ekor,
         sum(sum_realisasi_karkas) - avg(avg_konsumsi_bulanan) AS gap_kg, CAST(tahun * 100 + bulan AS INTEGER) AS time_key
  FROM cube GROUP BY tahun, bulan, nama_komoditas)"""
GAP_DIGITS = {"avg_permintaan": 4, "sum_karkas": 2, "avg_konsumsi": 4, "gap_ekor": 4, "gap_kg": 2}


@query("e16_monthly_gap", f"""WITH {CUBE}, {GAPS}
SELECT tahun, bulan, nama_komoditas, sum_vol_mutasi, time_key, {", ".join(f"{r(c, d)} AS {c}" for c, d in GAP_DIGITS.items())} FROM gaps""")
def monthly_gap(t: Source) -> DataFrame:
    return tidy(rollups.monthly_gap(standin.cube(t)), GAP_DIGITS)


@query("e17_gap_tiles", f"""WITH {CUBE}, {GAPS}
SELECT count(*) FILTER (gap_ekor > 0) AS n_surplus, count(*) FILTER (gap_ekor < 0) AS n_defisit,
       {r("avg(gap_ekor)", 0)} AS avg_gap_ekor, {r("avg(gap_kg)", 0)} AS avg_gap_kg FROM gaps""")
def gap_tiles(t: Source) -> DataFrame:
    return rollups.gap_tiles(rollups.monthly_gap(standin.cube(t)))


@query("e18_supply_demand_series", on_cube(f"""
SELECT tahun, bulan, nama_komoditas, tahun || '-' || lpad(CAST(bulan AS VARCHAR), 2, '0') AS tanggal,
       {r("coalesce(sum(sum_realisasi_karkas), 0)", 2)} AS sum_realisasi_karkas,
       {r("coalesce(sum(avg_konsumsi_bulanan), 0)", 2)} AS avg_konsumsi_bulanan
FROM cube WHERE nama_komoditas = 'PROMO' GROUP BY ALL"""))
def supply_demand_series(t: Source) -> DataFrame:
    out = rollups.supply_demand_series(standin.cube(t), "PROMO")
    return tidy(out, {"sum_realisasi_karkas": 2, "avg_konsumsi_bulanan": 2})


@query("e19_deficit_ranking", on_cube(f"""
SELECT nama_provinsi, nama_komoditas, {r("sum(sum_vol_mutasi) - sum(avg_permintaan_bulanan)", 4)} AS gap FROM cube GROUP BY ALL
HAVING sum(sum_vol_mutasi) - sum(avg_permintaan_bulanan) < 0 ORDER BY 3, 1, 2 LIMIT 12"""))
def deficit_ranking(t: Source) -> DataFrame:
    return ranking.deepest_deficits(tidy(rollups.deficits(standin.cube(t)), {"gap": 4}))


@query("e20_surplus_months", f"""WITH {CUBE}, {GAPS}
SELECT nama_komoditas, 'surplus' AS status, count(*) FILTER (gap_kg > 0) AS n FROM gaps GROUP BY 1
UNION ALL SELECT nama_komoditas, 'defisit', count(*) FILTER (gap_kg < 0) FROM gaps GROUP BY 1""")
def surplus_months(t: Source) -> DataFrame:
    return rollups.surplus_months(rollups.monthly_gap(standin.cube(t)))


SUMMARY_DIGITS = {"supply_risk_index": 6, "avg_harga": 4, "populasi_ternak": 4}


def summary_sql(where: str = "") -> str:
    return f"""summary AS (
  SELECT nama_provinsi, avg(supply_risk_index) AS supply_risk_index, avg(avg_harga) AS avg_harga,
         sum(sum_jumlah_sakit) AS sum_jumlah_sakit, sum(sum_vol_mutasi) AS sum_vol_mutasi, avg(populasi_ternak) AS populasi_ternak
  FROM cube {where} GROUP BY nama_provinsi)"""


@query("e21_spatial_roll_up", f"""WITH {CUBE}, {summary_sql("WHERE tahun = 1998 AND nama_komoditas = 'LARGE'")}
SELECT nama_provinsi, sum_jumlah_sakit, sum_vol_mutasi, {band_sql("supply_risk_index", 0.09, 0.06)} AS zona,
       {", ".join(f"{r(c, d)} AS {c}" for c, d in SUMMARY_DIGITS.items())} FROM summary""")
def spatial_roll_up(t: Source) -> DataFrame:
    rows = standin.cube(t).where("tahun = 1998 AND nama_komoditas = 'LARGE'")
    return tidy(rollups.regional_summary(rows, ((0.09, "BAHAYA"), (0.06, "WASPADA"))), SUMMARY_DIGITS)


@query("e22_disease_density", f"""WITH {CUBE}, {summary_sql()}
SELECT nama_provinsi, {r("populasi_ternak", 4)} AS populasi_ternak,
       {r("sum_jumlah_sakit / (greatest(populasi_ternak, 1) / 1000)", 4)} AS disease_density,
       {r("sum_jumlah_sakit / (populasi_ternak / 1000)", 2)} AS disease_density_2dp FROM summary""")
def disease_density(t: Source) -> DataFrame:
    out = rollups.disease_density(rollups.regional_summary(standin.cube(t)))
    return tidy(out.select("nama_provinsi", "populasi_ternak", "disease_density", "disease_density_2dp"),
                {"populasi_ternak": 4, "disease_density": 4})


CONCENTRATION = """conc AS (
  SELECT *, sum_vol * 100 / sum(sum_vol) OVER () AS pct,
         sum(sum_vol) OVER (ORDER BY sum_vol DESC, nama_provinsi ROWS UNBOUNDED PRECEDING) * 100 / sum(sum_vol) OVER () AS cumsum_pct
  FROM (SELECT nama_provinsi, sum(sum_vol_mutasi) AS sum_vol, avg(populasi_ternak) AS pop, avg(supply_risk_index) AS risk
        FROM cube GROUP BY nama_provinsi))"""


@query("e23_supply_concentration", f"""WITH {CUBE}, {CONCENTRATION}
SELECT nama_provinsi, sum_vol, {r("pop", 4)} AS pop, {r("risk", 6)} AS risk FROM conc""")
def supply_concentration(t: Source) -> DataFrame:
    out = rollups.supply_concentration(standin.cube(t)).select("nama_provinsi", "sum_vol", "pop", "risk")
    return tidy(out, {"pop": 4, "risk": 6})


@query("e24_vulnerable_regions", f"""WITH {CUBE}, {CONCENTRATION}
SELECT nama_provinsi, {r("sum_vol", 0)} AS vol_supply, {r("pct", 2)} AS pct_nasional, {r("risk", 4)} AS avg_risk
FROM conc WHERE pct >= 4 AND risk >= 0.08""")
def vulnerable_regions(t: Source) -> DataFrame:
    return rollups.vulnerable(rollups.supply_concentration(standin.cube(t)), share=4.0, index=0.08)


@query("e25_treemap_shares", on_lines(f"""
SELECT n_name AS nama_provinsi, sum(l_quantity) AS sum_vol, {r("sum(l_quantity) * 100 / sum(sum(l_quantity)) OVER ()", 6)} AS pct
FROM lines JOIN nation ON n_nationkey = id_asal GROUP BY n_name"""))
def treemap_shares(t: Source) -> DataFrame:
    rows = standin.lines(t, month=False, commodity=False).join(t("nation"), F.expr("n_nationkey = id_asal")).selectExpr(
        "n_name AS nama_provinsi", "l_quantity AS sum_vol_mutasi", "CAST(NULL AS double) AS populasi_ternak",
        "CAST(NULL AS double) AS supply_risk_index",
    )
    return tidy(rollups.supply_concentration(rows).select("nama_provinsi", "sum_vol", "pct"), {"pct": 6})


@query("e26_executive_summary", f"""WITH {CUBE}, {CONCENTRATION}
SELECT {r("(SELECT avg(supply_risk_index) FROM cube)", 6)} AS avg_risk,
       (SELECT count(DISTINCT nama_provinsi) FROM cube WHERE supply_risk_index >= 0.3) AS n_kritis,
       {r("(SELECT sum(pct) FROM (SELECT pct FROM conc ORDER BY sum_vol DESC, nama_provinsi LIMIT 3))", 6)} AS top_share""")
def executive_summary(t: Source) -> DataFrame:
    return tidy(rollups.executive_summary(standin.cube(t, staged=True), danger=0.3), {"avg_risk": 6, "top_share": 6})


HIDDEN_PRICE = "CASE WHEN o_orderkey % 20 <> 0 THEN o_totalprice END"


@query("e27_price_profile", f"""
SELECT count(*) AS n_rows, count(v) AS n_values, {r("avg(v)", 4)} AS mean, {r("stddev_samp(v)", 4)} AS std, min(v) AS min, max(v) AS max,
       strftime(min(o_orderdate), '%Y-%m-%d') AS first_time, strftime(max(o_orderdate), '%Y-%m-%d') AS last_time,
       count(*) FILTER (v IS NULL) AS n_null, {r("count(*) FILTER (v IS NULL) * 100.0 / count(*)", 2)} AS pct_null
FROM (SELECT *, {HIDDEN_PRICE} AS v FROM orders)""")
def price_profile(t: Source) -> DataFrame:
    rows = t("orders").selectExpr(f"{HIDDEN_PRICE} AS harga", "o_orderdate AS waktu")
    out = rollups.number_profile(rows, "harga", "waktu")
    out = out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_time", "last_time")})
    return tidy(out, {"mean": 4, "std": 4})


@query("e27_price_quartiles", f"""
SELECT o_orderpriority AS jenis, {r("quantile_cont(v, 0.25)", 4)} AS q1, {r("quantile_cont(v, 0.5)", 4)} AS q2, {r("quantile_cont(v, 0.75)", 4)} AS q3
FROM (SELECT *, {HIDDEN_PRICE} AS v FROM orders) GROUP BY 1""")
def price_quartiles(t: Source) -> DataFrame:
    rows = t("orders").selectExpr("o_orderpriority AS jenis", f"{HIDDEN_PRICE} AS harga")
    out = exact_quantiles(rows, ["jenis"], F.col("harga"), {"q1": 0.25, "q2": 0.5, "q3": 0.75}, "cont")
    return tidy(out, {"q1": 4, "q2": 4, "q3": 4})


@query("e27_distinct_lists", """
SELECT DISTINCT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders
UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders""")
def distinct_lists(t: Source) -> DataFrame:
    return rollups.distinct_values(t("orders"), ["o_orderstatus", "o_orderpriority"])


@query("e27_rows_per_region", """
SELECT n_name, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def rows_per_region(t: Source) -> DataFrame:
    orders = rollups.rows_per(t("orders"), "o_custkey")
    counts = orders.join(t("customer"), F.expr("c_custkey = o_custkey")).groupBy("c_nationkey").agg(F.sum("n").alias("n"))
    return counts.join(t("nation"), F.expr("n_nationkey = c_nationkey")).groupBy("n_name").agg(F.sum("n").alias("n"))


@query("e27_mean_price", on_lines(f"""
SELECT id_asal, p_type, {r("avg(l_extendedprice)", 0)} AS harga_rata2 FROM lines GROUP BY ALL"""))
def mean_price_list(t: Source) -> DataFrame:
    return rollups.mean_price_by(standin.lines(t, month=False), ["id_asal", "p_type"], "l_extendedprice")


@query("e28_monthly_scatter", on_cube(f"""
SELECT tahun, bulan, nama_komoditas, {r("avg(avg_harga)", 4)} AS avg_harga, sum(sum_jumlah_sakit) AS sum_sakit FROM cube GROUP BY ALL"""))
def monthly_scatter(t: Source) -> DataFrame:
    return tidy(rollups.price_scatter(standin.cube(t)), {"avg_harga": 4})
