"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.operators import conform, correlation, measures, quality, ranking, reshape, rollups, star
from lumbung.operators.imputation import fill_with_mean
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.plans.warehouse import ANNUAL_MEASURES, EVENT_SUMS, cube_of, integrate
from lumbung.session import stage
from lumbung.workload.base import (
    CUBE, DIMS, FACT, INTEGRATED, LINES, MONTHLY, n, on_cube, on_lines, query, r, tidy,
)

REGION_YEAR = ["provinsi", "tahun"]


def dirty_name(column: str, number: str) -> str:
    """Every other name in lower case with blanks around it."""
    return f"if({number} % 2 = 0, {column}, concat(' ', lower({column}), '  '))"


@query("d1_two_source_merge", f"""WITH {LINES}, sup AS (
  SELECT id_asal AS id, tahun, sum(l_quantity) AS populasi FROM lines WHERE id_asal % 5 <> 0 GROUP BY ALL),
dem AS (
  SELECT id_tujuan AS id, tahun, sum(l_quantity) AS permintaan FROM lines WHERE id_tujuan % 7 <> 0 GROUP BY ALL)
SELECT n_name AS provinsi, tahun, populasi, permintaan FROM sup JOIN dem USING (id, tahun) JOIN nation ON n_nationkey = id""")
def two_source_merge(t: Source) -> DataFrame:
    # Both sides come from one pass over the lines.
    sums = standin.lines(t, commodity=False, destination=True).groupingSets(
        [["id_asal", "tahun"], ["id_tujuan", "tahun"]], "id_asal", "id_tujuan", "tahun"
    ).agg(F.sum("l_quantity").alias("v"))
    sums = stage(sums, "sides")
    name = t("nation").selectExpr("n_nationkey AS id", "n_name AS provinsi")

    def side(region: str, value: str, gap: int) -> DataFrame:
        rows = sums.where(f"{region} % {gap} <> 0").selectExpr(f"{region} AS id", "tahun", f"v AS {value}")
        return rows.join(name, "id").drop("id")

    return conform.merge_sources(
        side("id_asal", "q", 5), side("id_tujuan", "w", 7), REGION_YEAR,
        {"populasi": F.col("q"), "permintaan": F.col("w")},
    )


@query("d2_name_to_id", """
SELECT CASE WHEN n_nationkey % 6 <> 0 THEN n_nationkey END AS id_wilayah, count(*) AS n, count(DISTINCT c_mktsegment) AS n_segmen
FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def name_to_id(t: Source) -> DataFrame:
    named = t("customer").join(t("nation"), F.expr("n_nationkey = c_nationkey")).selectExpr("n_name AS provinsi", "c_mktsegment")
    ids = t("nation").where("n_nationkey % 6 <> 0").selectExpr("n_nationkey AS id_wilayah", "n_name AS provinsi")
    out = conform.replace_name_by_id(named, ids)
    return out.groupBy("id_wilayah").agg(n(), F.count_distinct("c_mktsegment").alias("n_segmen"))


@query("d3_reconcile_regions", """
SELECT coalesce(a.id, b.id) AS id_wilayah, coalesce(a.nm, b.nm) AS provinsi
FROM (SELECT DISTINCT s_nationkey AS id, n_name AS nm FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_nationkey < 15) a
FULL JOIN (SELECT DISTINCT c_nationkey + 100 AS id, lower(n_name) AS nm FROM customer JOIN nation ON n_nationkey = c_nationkey
           WHERE c_nationkey >= 10) b ON lower(a.nm) = b.nm""")
def reconcile_regions(t: Source) -> DataFrame:
    nation = t("nation")
    left = t("supplier").where("s_nationkey < 15").join(nation, F.expr("n_nationkey = s_nationkey"))
    right = t("customer").where("c_nationkey >= 10").join(nation, F.expr("n_nationkey = c_nationkey"))
    return conform.reconcile_regions(
        left.selectExpr("n_nationkey AS id_wilayah", "n_name AS provinsi").distinct(),
        right.selectExpr("n_nationkey + 100 AS id_wilayah", "lower(n_name) AS provinsi").distinct(),
    )


@query("d4_event_lookup", """
SELECT p_type, count(*) AS n, sum(l_quantity) AS qty FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 9 <> 0)
ON p_partkey = l_partkey GROUP BY p_type""")
def event_lookup(t: Source) -> DataFrame:
    species = t("part").where("p_partkey % 9 <> 0").selectExpr("p_partkey AS id_hewan", "p_type")
    # Lines are summed by part before the lookup: the join sees each part once.
    raw = t("lineitem").groupBy(F.col("l_partkey").alias("id_hewan")).agg(n(), F.sum("l_quantity").alias("qty"))
    return conform.lookup(raw, species, "id_hewan").groupBy("p_type").agg(F.sum("n").alias("n"), F.sum("qty").alias("qty"))


@query("d5_normalised_name_join", """
SELECT n_nationkey, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def normalised_name_join(t: Source) -> DataFrame:
    counts = t("customer").join(t("nation"), F.expr("n_nationkey = c_nationkey")).groupBy(
        F.expr(dirty_name("n_name", "c_custkey") + " AS provinsi")
    ).agg(n())
    joined = conform.join_by_name(counts, t("nation").select("n_nationkey", "n_name"), "provinsi", "n_name")
    return joined.groupBy("n_nationkey").agg(F.sum("n").alias("n"))


@query("d6_unmatched_names", """
SELECT DISTINCT 'Atlantis ' || n_nationkey AS provinsi FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 20 = 0""")
def unmatched_names(t: Source) -> DataFrame:
    named = t("customer").join(t("nation"), F.expr("n_nationkey = c_nationkey")).selectExpr(
        f"if(c_custkey % 20 = 0, concat('Atlantis ', n_nationkey), {dirty_name('n_name', 'c_custkey')}) AS provinsi"
    )
    return conform.unmatched_names(named, t("nation"), "provinsi", "n_name")


@query("d7_metric_merge", f"""WITH {LINES}, keyed AS (
  SELECT id_asal AS id_wilayah, bulan, tahun, id_komoditas, * EXCLUDE (id_asal, bulan, tahun, id_komoditas) FROM lines),
a AS (SELECT id_wilayah, bulan, tahun, id_komoditas, sum(l_quantity) AS sum_jumlah_sakit FROM keyed WHERE l_returnflag = 'R' GROUP BY ALL),
b AS (SELECT id_wilayah, bulan, tahun, id_komoditas, sum(l_quantity) AS sum_vol_mutasi FROM keyed WHERE l_returnflag <> 'R' GROUP BY ALL),
c AS (SELECT id_wilayah, bulan, tahun, id_komoditas, {r("sum(l_extendedprice * (1 - l_discount))", 2)} AS sum_realisasi_karkas
      FROM keyed WHERE l_linestatus = 'F' GROUP BY ALL),
d AS (SELECT id_wilayah, bulan, tahun, id_komoditas, {r("avg(l_extendedprice / l_quantity)", 4)} AS avg_harga
      FROM keyed WHERE l_orderkey % 3 = 0 GROUP BY ALL)
SELECT * FROM a FULL JOIN b USING (id_wilayah, bulan, tahun, id_komoditas) FULL JOIN c USING (id_wilayah, bulan, tahun, id_komoditas)
FULL JOIN d USING (id_wilayah, bulan, tahun, id_komoditas)""")
def metric_merge(t: Source) -> DataFrame:
    rows = standin.lines(t).withColumnRenamed("id_asal", "id_wilayah")
    # One pass with conditional sums feeds the frames that arrive separately in a warehouse load.
    base = stage(rows.groupBy(*measures.KEYS).agg(
        F.expr(f"sum({standin.RETURNED}) AS a"), F.expr("sum(if(l_returnflag <> 'R', l_quantity, NULL)) AS b"),
        F.expr(f"sum(if(l_linestatus = 'F', {standin.REVENUE}, NULL)) AS c"),
        F.expr(f"avg(if(l_orderkey % 3 = 0, {standin.UNIT_PRICE}, NULL)) AS d"),
    ), "measures")
    frames = [
        base.where(F.col(c).isNotNull()).select(*measures.KEYS, F.col(c).alias(name))
        for c, name in (("a", "sum_jumlah_sakit"), ("b", "sum_vol_mutasi"), ("c", "sum_realisasi_karkas"), ("d", "avg_harga"))
    ]
    return tidy(measures.merge_measures(frames), {"sum_realisasi_karkas": 2, "avg_harga": 4})


@query("d8_annual_demography", f"""WITH {LINES}, st AS (
  SELECT id_asal AS id_wilayah, tahun, id_komoditas, sum(l_quantity) AS populasi FROM lines GROUP BY ALL),
dem AS (SELECT c_nationkey AS id_wilayah, CAST(year(o_orderdate) AS INTEGER) AS tahun, count(*) AS jumlah_penduduk
        FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey % 4 <> 0 GROUP BY ALL)
SELECT * FROM st LEFT JOIN dem USING (id_wilayah, tahun)""")
def annual_demography(t: Source) -> DataFrame:
    rows = standin.lines(t)
    stats = rows.groupBy(F.col("id_asal").alias("id_wilayah"), "tahun", "id_komoditas").agg(F.sum("l_quantity").alias("populasi"))
    buyers = t("customer").where("c_nationkey % 4 <> 0").selectExpr("c_custkey AS o_custkey", "c_nationkey AS id_wilayah")
    people = t("orders").join(buyers, "o_custkey").groupBy("id_wilayah", F.year("o_orderdate").alias("tahun")).agg(
        F.count(F.lit(1)).alias("jumlah_penduduk")
    )
    return measures.with_demography(stats, people)


@query("d9_month_by_year", f"""WITH {INTEGRATED}
SELECT id_wilayah, tahun, bulan, id_komoditas, {", ".join(EVENT_SUMS)}, {r("avg_harga", 4)} AS avg_harga,
       {r("populasi_ternak", 4)} AS populasi_ternak, {r("avg_permintaan_bulanan", 4)} AS avg_permintaan_bulanan FROM integrated""")
def month_by_year(t: Source) -> DataFrame:
    flows = stage(standin.flow(t), "flow")
    stats = fill_with_mean(standin.annual(flows), ["id_wilayah", "id_komoditas"], ANNUAL_MEASURES)
    out = integrate(standin.monthly(flows), stats, standin.demography(t), ["id_wilayah"])
    out = out.select(*measures.KEYS, *EVENT_SUMS, "avg_harga", "populasi_ternak", "avg_permintaan_bulanan")
    return tidy(out, {"avg_harga": 4, "populasi_ternak": 4, "avg_permintaan_bulanan": 4})


@query("d10_surrogate_keys", f"""WITH {MONTHLY}{DIMS}
SELECT prov_key, waktu_key, komoditas_key, sum_vol_mutasi FROM monthly
JOIN (SELECT * FROM dim_prov WHERE id_prov <> 4) ON id_prov = id_wilayah JOIN dim_komoditas USING (id_komoditas)
JOIN dim_waktu USING (tahun, bulan)""")
def surrogate_keys(t: Source) -> DataFrame:
    dims = standin.dims_of(t)
    rows = standin.lines(t).groupBy(F.col("id_asal").alias("id_wilayah"), "tahun", "bulan", "id_komoditas").agg(
        F.sum("l_quantity").alias("sum_vol_mutasi")
    )
    keyed = star.with_keys(rows, dims["dim_prov"].where("id_prov <> 4"), dims["dim_komoditas"], dims["dim_waktu"])
    return keyed.select(*star.FACT_KEYS, "sum_vol_mutasi")


STAR_COLUMNS = "prov_key, waktu_key, komoditas_key, nama_provinsi, tahun, bulan, kuartal, nama_komoditas, supply_risk_index, avg_harga"


@query("d11_star_cube_left", f"""WITH {FACT}
SELECT f.prov_key, f.waktu_key, f.komoditas_key, nama_provinsi, tahun, bulan, kuartal, nama_komoditas, supply_risk_index, avg_harga
FROM fact f LEFT JOIN (SELECT * FROM dim_prov WHERE prov_key <> 3) p ON f.prov_key = p.prov_key
LEFT JOIN dim_waktu w ON f.waktu_key = w.waktu_key LEFT JOIN dim_komoditas k ON f.komoditas_key = k.komoditas_key""")
def star_cube_left(t: Source) -> DataFrame:
    tables = standin.warehouse(t)
    tables["dim_prov"] = tables["dim_prov"].where("prov_key <> 3")
    return cube_of(tables, "left").select(*STAR_COLUMNS.split(", "))


@query("d12_star_cube_inner", on_cube(f"SELECT {STAR_COLUMNS} FROM cube"))
def star_cube_inner(t: Source) -> DataFrame:
    return standin.cube(t).orderBy("tahun", "bulan", "nama_provinsi", "nama_komoditas").select(*STAR_COLUMNS.split(", "))


@query("d13_orphan_keys", """
SELECT 'orphan_key' AS check_name, 'orders' AS table_name, 'o_custkey' AS column_name, count(DISTINCT o_custkey) AS bad_rows
FROM orders WHERE o_custkey % 25 = 0""")
def orphan_keys(t: Source) -> DataFrame:
    return quality.orphan_keys("orders", t("orders"), "o_custkey", t("customer").where("c_custkey % 25 <> 0"), "c_custkey")


@query("d14_orphan_rows", """
SELECT 'orphan_row' AS check_name, 'orders' AS table_name, 'o_custkey' AS column_name, count(*) AS bad_rows
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 25 <> 0) ON c_custkey = o_custkey WHERE c_custkey IS NULL""")
def orphan_rows(t: Source) -> DataFrame:
    return quality.orphan_rows("orders", t("orders"), "o_custkey", t("customer").where("c_custkey % 25 <> 0"), "c_custkey")


UPSTREAM = ("NATION_0", "NATION_1", "NATION_2")
DOWNSTREAM = ("NATION_3", "NATION_4", "NATION_5")


def series_sql(up: str, down: str, commodity: str, measure: str = "sum_jumlah_sakit") -> str:
    """CTE ``series``: months with upstream total and downstream mean price, numbered."""
    return f"""series AS (
  SELECT tahun, bulan, x_wabah, y_harga, CAST(row_number() OVER (ORDER BY tahun, bulan) AS INTEGER) AS t FROM
  (SELECT tahun, bulan, sum({measure}) AS x_wabah FROM cube WHERE nama_komoditas = '{commodity}' AND nama_provinsi IN {up} GROUP BY ALL)
  JOIN (SELECT tahun, bulan, avg(avg_harga) AS y_harga FROM cube WHERE nama_komoditas = '{commodity}' AND nama_provinsi IN {down} GROUP BY ALL)
  USING (tahun, bulan))"""


@query("d15_two_region_series", f"""WITH {CUBE}, {series_sql(UPSTREAM, DOWNSTREAM, "SMALL")}
SELECT tahun, bulan, t, x_wabah, {r("y_harga", 4)} AS y_harga, tahun || '/' || lpad(CAST(bulan AS VARCHAR), 2, '0') AS periode FROM series""")
def two_region_series(t: Source) -> DataFrame:
    series = correlation.two_region_series(standin.cube(t), UPSTREAM, DOWNSTREAM, "SMALL")
    return tidy(series, {"y_harga": 4})


@query("d16_indicator_merge", f"""
SELECT user_id, strftime(ts, '%Y-%m-%d') AS hari, event_type AS indikator, {r("sum(value)", 4)} AS nilai
FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL GROUP BY ALL""")
def indicator_merge(t: Source) -> DataFrame:
    """The filled cells of the merged table, whose columns are the types that the events have."""
    events = t("events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("hari"), "event_type", "value")
    types = sorted(row.event_type for row in events.where("event_type IS NOT NULL").select("event_type").distinct().collect())
    wide = reshape.merge_indicators(events, ["user_id", "hari"], "event_type", "value", types, F.sum)
    cells = reshape.longer(wide, ["user_id", "hari"], types, "indikator", "nilai").where("nilai IS NOT NULL")
    return tidy(cells, {"nilai": 4})


MAP_ALIASES = {f"N{i}": f"NATION_{i}" for i in range(12)}
SUMMARY_SQL = f"""summary AS (
  SELECT nama_provinsi, avg(supply_risk_index) AS supply_risk_index, avg(avg_harga) AS avg_harga,
         sum(sum_jumlah_sakit) AS sum_jumlah_sakit, sum(sum_vol_mutasi) AS sum_vol_mutasi, avg(populasi_ternak) AS populasi_ternak
  FROM cube WHERE tahun = 1999 GROUP BY nama_provinsi)"""


@query("d17_map_join", f"""WITH {CUBE}, {SUMMARY_SQL}
SELECT CASE WHEN n_nationkey < 12 THEN 'n' || n_nationkey ELSE n_name END AS provinsi, s.nama_provinsi,
       {r("supply_risk_index", 6)} AS supply_risk_index, sum_jumlah_sakit
FROM nation LEFT JOIN (SELECT * FROM summary WHERE nama_provinsi <> 'NATION_9') s ON s.nama_provinsi = n_name""")
def map_join(t: Source) -> DataFrame:
    metrics = rollups.regional_summary(standin.cube(t).where("tahun = 1999")).where("nama_provinsi <> 'NATION_9'")
    shapes = t("nation").selectExpr("if(n_nationkey < 12, concat('n', n_nationkey), n_name) AS provinsi")
    out = conform.map_join(shapes, metrics, MAP_ALIASES)
    return tidy(out, {"supply_risk_index": 6}).select("provinsi", "nama_provinsi", "supply_risk_index", "sum_jumlah_sakit")


@query("d18_missing_centres", f"""WITH {CUBE}, {SUMMARY_SQL}
SELECT upper(nama_provinsi) AS nama_provinsi FROM summary
WHERE nama_provinsi NOT IN (SELECT n_name FROM nation WHERE n_nationkey % 11 <> 0) AND supply_risk_index IS NOT NULL""")
def missing_centres(t: Source) -> DataFrame:
    metrics = rollups.regional_summary(standin.cube(t).where("tahun = 1999"))
    centres = t("nation").where("n_nationkey % 11 <> 0").selectExpr("lower(n_name) AS nama_provinsi")
    return conform.without_centre(centres, metrics)


@query("d18_centre_join", f"""WITH {CUBE}, {SUMMARY_SQL}
SELECT nama_provinsi, {r("supply_risk_index", 6)} AS supply_risk_index, lat, lon,
       {r("greatest(6, least(30, supply_risk_index * 40))", 4)} AS radius
FROM (SELECT n_name AS nama_provinsi, n_nationkey * 1.5e0 AS lat, 100e0 + n_nationkey AS lon FROM nation WHERE n_nationkey <> 11)
JOIN summary USING (nama_provinsi)""")
def centre_join(t: Source) -> DataFrame:
    metrics = rollups.regional_summary(standin.cube(t).where("tahun = 1999"))
    centres = t("nation").where("n_nationkey <> 11").selectExpr(
        "lower(n_name) AS nama_provinsi", "n_nationkey * 1.5D AS lat", "100D + n_nationkey AS lon"
    )
    out = conform.centre_join(centres, metrics).select("nama_provinsi", "supply_risk_index", "lat", "lon", "radius")
    return tidy(out, {"supply_risk_index": 6, "radius": 4})


@query("d19_top_drill_down", on_cube(f"""
SELECT tahun, bulan, nama_provinsi, {r("avg(supply_risk_index)", 6)} AS risk,
       tahun || '/' || lpad(CAST(bulan AS VARCHAR), 2, '0') AS periode
FROM cube WHERE nama_provinsi IN (
  SELECT nama_provinsi FROM cube GROUP BY 1 ORDER BY {r("avg(supply_risk_index)", 9)} DESC, nama_provinsi LIMIT 5) GROUP BY ALL"""))
def top_drill_down(t: Source) -> DataFrame:
    return tidy(ranking.top_region_timeline(standin.cube(t, staged=True), 5), {"risk": 6})


@query("d20_group_join_back", on_lines(f"""
SELECT id_asal, id_komoditas, count(*) AS n, {r("sum(abs(l_extendedprice - m))", 2)} AS jarak FROM (
  SELECT *, avg(l_extendedprice) OVER (PARTITION BY id_asal, id_komoditas) AS m FROM lines) GROUP BY ALL"""))
def group_join_back(t: Source) -> DataFrame:
    rows = stage(standin.lines(t, month=False).select("id_asal", "id_komoditas", "l_extendedprice"), "prices")
    means = stage(rows.groupBy("id_asal", "id_komoditas").agg(F.avg("l_extendedprice").alias("m")), "means")
    out = rows.join(means, ["id_asal", "id_komoditas"], "left").groupBy("id_asal", "id_komoditas").agg(
        n(), F.expr("sum(abs(l_extendedprice - m)) AS jarak")
    )
    return tidy(out, {"jarak": 2})
