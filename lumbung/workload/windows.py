"""Window functions and top-k lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumbung.functions import risk
from lumbung.operators import correlation, imputation, ranking, rollups
from lumbung.operators.dimensions import commodity_dimension_of, region_dimension, time_dimension
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.session import stage, stage_path
from lumbung.sources import sinks
from lumbung.workload.aggregates import CONCENTRATION
from lumbung.workload.base import CUBE, DIMS, INTEGRATED, on_cube, on_lines, query, r, tidy
from lumbung.workload.joins import DOWNSTREAM, UPSTREAM, series_sql
from lumbung.workload.statistics import PAIRS, SCAN, series_of


@query("f1_surrogate_keys", f"""WITH {DIMS.lstrip(', ')}
SELECT 'prov' AS dim, prov_key AS kunci, nama_provinsi AS nama FROM dim_prov
UNION ALL SELECT 'waktu', waktu_key, tahun || '/' || lpad(CAST(bulan AS VARCHAR), 2, '0') FROM dim_waktu
UNION ALL SELECT 'komoditas', komoditas_key, nama_komoditas FROM dim_komoditas""")
def surrogate_keys(t: Source) -> DataFrame:
    prov = region_dimension(t("nation"), "n_name").selectExpr("'prov' AS dim", "prov_key AS kunci", "nama_provinsi AS nama")
    time = standin.dims_of(t)["dim_waktu"].selectExpr("'waktu' AS dim", "waktu_key AS kunci", "format_string('%d/%02d', tahun, bulan) AS nama")
    kind = commodity_dimension_of(t("part"), "p_type").selectExpr("'komoditas' AS dim", "komoditas_key AS kunci", "nama_komoditas AS nama")
    return prov.unionByName(time).unionByName(kind)


@query("f1_lasting_keys", f"""WITH {DIMS.lstrip(', ')},
old_prov AS (SELECT n_name, row_number() OVER (ORDER BY n_name) AS k FROM nation WHERE n_nationkey % 3 <> 0),
old_waktu AS (SELECT tahun, bulan, row_number() OVER (ORDER BY tahun, bulan) AS k FROM dim_waktu WHERE tahun > (SELECT min(tahun) + 1 FROM dim_waktu)),
keyed AS (
  SELECT 'prov' AS dim, k AS kunci, n_name AS nama FROM old_prov
  UNION ALL SELECT 'prov', (SELECT count(*) FROM old_prov) + row_number() OVER (ORDER BY n_name), n_name FROM nation WHERE n_nationkey % 3 = 0
  UNION ALL SELECT 'waktu', k, tahun || '/' || lpad(CAST(bulan AS VARCHAR), 2, '0') FROM old_waktu
  UNION ALL SELECT 'waktu', (SELECT count(*) FROM old_waktu) + row_number() OVER (ORDER BY tahun, bulan), tahun || '/' || lpad(CAST(bulan AS VARCHAR), 2, '0')
  FROM dim_waktu WHERE tahun <= (SELECT min(tahun) + 1 FROM dim_waktu))
SELECT dim, CAST(kunci AS INTEGER) AS kunci, nama FROM keyed""")
def lasting_keys(t: Source) -> DataFrame:
    """Keys of a second run that finds more regions and earlier years than the first."""
    names = t("nation")
    first = region_dimension(names.where("n_nationkey % 3 <> 0"), "n_name")
    prov = region_dimension(names, "n_name", first).selectExpr("'prov' AS dim", "prov_key AS kunci", "nama_provinsi AS nama")
    months = standin.dims_of(t)["dim_waktu"].select("tahun", "bulan")
    later = months.where(F.col("tahun") > months.agg(F.min("tahun") + 1).scalar())
    time = time_dimension(months, time_dimension(later)).selectExpr("'waktu' AS dim", "waktu_key AS kunci", "format_string('%d/%02d', tahun, bulan) AS nama")
    return prov.unionByName(time)


@query("f2_last_known", f"""WITH {INTEGRATED}
SELECT id_wilayah, id_komoditas, tahun, bulan, {r('''last_value(avg_harga IGNORE NULLS) OVER (
  PARTITION BY id_wilayah, id_komoditas ORDER BY tahun, bulan ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)''', 4)} AS harga_lalu
FROM integrated""")
def last_known(t: Source) -> DataFrame:
    monthly = standin.monthly(standin.flow(t))
    earlier = imputation.last_known("avg_harga", ["id_wilayah", "id_komoditas"], ["tahun", "bulan"])
    out = monthly.select("id_wilayah", "id_komoditas", "tahun", "bulan", earlier.alias("harga_lalu"))
    return tidy(out, {"harga_lalu": 4})


@query("f3_pareto", f"""WITH {CUBE}, {CONCENTRATION}
SELECT nama_provinsi, sum_vol, {r("pct", 6)} AS pct, {r("cumsum_pct", 6)} AS cumsum_pct FROM conc""")
def pareto(t: Source) -> DataFrame:
    out = rollups.supply_concentration(standin.cube(t)).select("nama_provinsi", "sum_vol", "pct", "cumsum_pct")
    return tidy(out, {"pct": 6, "cumsum_pct": 6})


@query("f4_lead_pairs", f"""WITH {CUBE}, {series_sql(UPSTREAM, DOWNSTREAM, "SMALL")}, {PAIRS.format(max_lag=6)}
SELECT lag, t, x, {r("y", 4)} AS y FROM pairs""")
def lead_pairs(t: Source) -> DataFrame:
    return tidy(correlation.lag_pairs(series_of(t), 6), {"y": 4})


@query("f5_lag_shift", f"""WITH {CUBE}, {series_sql(UPSTREAM, DOWNSTREAM, "SMALL")}
SELECT t, x_wabah, lag(x_wabah, 2) OVER (ORDER BY t) AS wabah_shifted FROM series""")
def lag_shift(t: Source) -> DataFrame:
    return series_of(t).select("t", "x_wabah", F.lag("x_wabah", 2).over(W.orderBy("t")).alias("wabah_shifted"))


@query("f6_sequence_number", on_lines("""
SELECT tahun, bulan, CAST(row_number() OVER (ORDER BY tahun, bulan) AS INTEGER) AS t, count(*) AS n FROM lines GROUP BY tahun, bulan"""))
def sequence_number(t: Source) -> DataFrame:
    months = standin.lines(t, commodity=False, origin=False).groupBy("tahun", "bulan").agg(F.count(F.lit(1)).alias("n"))
    return months.withColumn("t", F.row_number().over(W.orderBy("tahun", "bulan")))


@query("f7_latest_per_group", on_lines("""
SELECT id_asal, count(*) AS n, sum(l_quantity) AS qty, max(m) AS bulan_terakhir FROM (
  SELECT *, tahun * 100 + bulan AS m, max(tahun * 100 + bulan) OVER (PARTITION BY id_asal) AS mm FROM lines) WHERE m = mm GROUP BY 1"""))
def latest_per_group(t: Source) -> DataFrame:
    # Months are summed first, so that the lines are read once and the join sees months only.
    months = standin.lines(t, commodity=False).groupBy("id_asal", F.expr("tahun * 100 + bulan AS bulan_terakhir")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty")
    )
    return rollups.latest_rows(stage(months, "months"), "id_asal", "bulan_terakhir")


@query("f8_z_score", f"""WITH {CUBE}, {series_sql(UPSTREAM, DOWNSTREAM, "SMALL")}
SELECT t, {r("(y_harga - avg(y_harga) OVER ()) / stddev_samp(y_harga) OVER ()", 6)} AS z_harga,
       {r("(x_wabah - avg(x_wabah) OVER ()) / stddev_samp(x_wabah) OVER ()", 6)} AS z_wabah FROM series""")
def z_score(t: Source) -> DataFrame:
    out = series_of(t).select("t", correlation.z_score("y_harga").alias("z_harga"), correlation.z_score("x_wabah").alias("z_wabah"))
    return tidy(out, {"z_harga": 6, "z_wabah": 6})


@query("f9_share_of_total", on_lines(f"""
SELECT p_type, sum(l_quantity) AS qty, {r("sum(l_quantity) * 100 / sum(sum(l_quantity)) OVER ()", 6)} AS pct FROM lines GROUP BY p_type"""))
def share_of_total(t: Source) -> DataFrame:
    sums = standin.lines(t, month=False, origin=False).groupBy("p_type").agg(F.sum("l_quantity").alias("qty"))
    return tidy(sums.withColumn("pct", F.col("qty") * 100 / F.sum("qty").over(W.partitionBy())), {"pct": 6})


@query("g1_top_index_rows", on_cube("""
SELECT nama_provinsi, tahun, bulan, nama_komoditas, supply_risk_index, sum_jumlah_sakit, populasi_ternak FROM cube
ORDER BY supply_risk_index DESC, nama_provinsi, tahun, bulan, nama_komoditas LIMIT 10"""))
def top_index_rows(t: Source) -> DataFrame:
    return ranking.top_index_rows(standin.cube(t), 10)


@query("g2_top_regions", on_cube(f"""
SELECT nama_provinsi, {r("avg(supply_risk_index)", 6)} AS avg_risk FROM cube GROUP BY 1
ORDER BY avg(supply_risk_index) DESC, nama_provinsi LIMIT 10"""))
def top_regions(t: Source) -> DataFrame:
    return tidy(ranking.top_regions(standin.cube(t), 10), {"avg_risk": 6})


@query("g3_bottom_deficits", on_lines(f"""
SELECT id_wilayah, id_komoditas, gap FROM (
  SELECT id_wilayah, id_komoditas, coalesce(a, 0) - coalesce(b, 0) AS gap FROM
  (SELECT id_asal AS id_wilayah, id_komoditas, sum(l_quantity) AS a FROM lines GROUP BY ALL)
  FULL JOIN (SELECT id_tujuan AS id_wilayah, id_komoditas, sum(l_quantity) AS b FROM lines GROUP BY ALL) USING (id_wilayah, id_komoditas))
WHERE gap < 0 ORDER BY gap, id_wilayah, id_komoditas LIMIT 12"""))
def bottom_deficits(t: Source) -> DataFrame:
    roles = "inline(array(named_struct('id_wilayah', id_asal, 'q', l_quantity), named_struct('id_wilayah', id_tujuan, 'q', -l_quantity)))"
    rows = standin.lines(t, month=False, destination=True).selectExpr("id_komoditas", roles)
    gaps = rows.groupBy("id_wilayah", "id_komoditas").agg(F.sum("q").alias("gap")).where("gap < 0")
    return ranking.top(gaps, ["gap", "id_wilayah", "id_komoditas"], 12)


@query("g4_pareto_head", f"""WITH {CUBE}, {CONCENTRATION}
SELECT nama_provinsi, sum_vol, {r("cumsum_pct", 6)} AS cumsum_pct, CASE WHEN risk > 0.085 THEN 'BAHAYA' ELSE 'AMAN' END AS status
FROM conc ORDER BY sum_vol DESC, nama_provinsi LIMIT 15""")
def pareto_head(t: Source) -> DataFrame:
    head = ranking.top_suppliers(rollups.supply_concentration(standin.cube(t)), 15)
    out = head.select("nama_provinsi", "sum_vol", "cumsum_pct", risk.above("risk", 0.085).alias("status"))
    return tidy(out, {"cumsum_pct": 6})


@query("g5_peak_lag", f"""WITH {CUBE}, {series_sql(UPSTREAM, DOWNSTREAM, "SMALL")}, {PAIRS.format(max_lag=6)}, {SCAN}
SELECT lag, {r("r", 6)} AS r, {r("p", 6)} AS p, p < 0.05 AS signifikan FROM scan ORDER BY abs(r) DESC, lag LIMIT 1""")
def peak_lag(t: Source) -> DataFrame:
    return tidy(correlation.peak_lag(correlation.lag_scan(series_of(t))), {"r": 6, "p": 6})


@query("g6_ordered_output", on_lines("""
SELECT n_name, tahun, bulan, sum(l_quantity) AS qty FROM lines JOIN nation ON n_nationkey = id_asal GROUP BY ALL"""))
def ordered_output(t: Source) -> DataFrame:
    rows = standin.lines(t, commodity=False).join(t("nation"), F.expr("n_nationkey = id_asal"))
    path = stage_path(t.spark, "ordered")
    sinks.export_csv(rows.groupBy("n_name", "tahun", "bulan").agg(F.sum("l_quantity").alias("qty")), path, ["tahun", "bulan", "n_name"])
    return t.spark.read.schema("n_name string, tahun int, bulan int, qty double").csv(path, header=True)
