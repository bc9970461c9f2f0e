"""Imputation and the composite index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import risk
from lumbung.operators import imputation, index
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.plans.standin_staging import staging
from lumbung.plans.warehouse import ANNUAL_MEASURES, build_warehouse, cube_of
from lumbung.session import stage
from lumbung.workload.base import ANNUAL, COMPONENTS, FILLED, INTEGRATED, KINDS, LINES, SCALED, on_cube, query, r, tidy

HIDDEN = "CASE WHEN l_orderkey % 20 <> 0 THEN l_extendedprice END"
GROUP = ["id_asal", "id_komoditas", "bulan"]
ROW = ("id_wilayah", "tahun", "bulan", "id_komoditas")


@query("i1_price_median_fill", f"""WITH {LINES}, h AS (SELECT *, {HIDDEN} AS harga FROM lines),
m AS (SELECT id_asal, id_komoditas, bulan, quantile_disc(harga, 0.5) AS med FROM h WHERE harga IS NOT NULL GROUP BY ALL)
SELECT id_asal, id_komoditas, bulan, count(*) AS n, count(coalesce(harga, med)) AS n_isi, {r("sum(coalesce(harga, med))", 2)} AS total
FROM h LEFT JOIN m USING (id_asal, id_komoditas, bulan) GROUP BY ALL""")
def price_median_fill(t: Source) -> DataFrame:
    rows = stage(standin.lines(t).select(*GROUP, F.expr(f"{HIDDEN} AS harga")), "prices")
    out = imputation.fill_with_median(rows, GROUP, "harga").groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), F.count("harga").alias("n_isi"), F.sum("harga").alias("total")
    )
    return tidy(out, {"total": 2})


@query("i2_annual_mean_fill", f"""WITH {ANNUAL}
SELECT id_wilayah, tahun, id_komoditas, {r("harga_baseline", 3)} AS harga_baseline,
       {", ".join(f"{r(c, 3)} AS {c}" for c in ANNUAL_MEASURES)} FROM annual_full""")
def annual_mean_fill(t: Source) -> DataFrame:
    out = imputation.fill_with_mean(standin.annual(standin.flow(t)), ["id_wilayah", "id_komoditas"], ANNUAL_MEASURES)
    return tidy(out, dict.fromkeys([*ANNUAL_MEASURES, "harga_baseline"], 3))


@query("i3_price_cascade", f"""WITH {FILLED} SELECT {", ".join(ROW)}, {r("avg_harga", 4)} AS avg_harga FROM filled""")
def price_cascade(t: Source) -> DataFrame:
    filled = imputation.fill_price_gaps(standin.staged_integrated(t))
    return tidy(filled.select(*ROW, "avg_harga"), {"avg_harga": 4})


@query("i4_source_fallback", """
SELECT o_custkey, coalesce(max(CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END), max(o_totalprice)) AS nilai FROM orders GROUP BY 1""")
def source_fallback(t: Source) -> DataFrame:
    best = t("orders").groupBy("o_custkey").agg(
        F.max(F.when(F.expr("o_orderkey % 3 <> 0"), F.col("o_totalprice"))).alias("api"), F.max("o_totalprice").alias("pengganti")
    )
    return best.select("o_custkey", F.coalesce("api", "pengganti").alias("nilai"))


@query("i5_null_audit", f"""WITH {ANNUAL}
SELECT 'populasi' AS column_name, count(*) FILTER (a.populasi IS NULL) AS nulls_before, count(*) FILTER (f.populasi IS NULL) AS nulls_after
FROM annual a JOIN annual_full f USING (id_wilayah, tahun, id_komoditas)
UNION ALL SELECT 'permintaan_daging', count(*) FILTER (a.permintaan_daging IS NULL), count(*) FILTER (f.permintaan_daging IS NULL)
FROM annual a JOIN annual_full f USING (id_wilayah, tahun, id_komoditas)""")
def null_audit(t: Source) -> DataFrame:
    before = standin.annual(standin.staged_flow(t))
    after = imputation.fill_with_mean(before, ["id_wilayah", "id_komoditas"], ANNUAL_MEASURES)
    return imputation.null_audit(before, after, ["populasi", "permintaan_daging"])


def filled_rows(t: Source) -> DataFrame:
    return imputation.fill_price_gaps(standin.staged_integrated(t))


def component(name: str):
    return f"WITH {COMPONENTS} SELECT {', '.join(ROW)}, {r(f'raw_{name}', 6)} AS raw_{name} FROM components"


@query("j1_price_gap", component("price_gap"))
def price_gap(t: Source) -> DataFrame:
    return tidy(filled_rows(t).select(*ROW, risk.price_gap().alias("raw_price_gap")), {"raw_price_gap": 6})


@query("j2_health_impact", component("health_impact"))
def health_impact(t: Source) -> DataFrame:
    return tidy(filled_rows(t).select(*ROW, risk.health_impact().alias("raw_health_impact")), {"raw_health_impact": 6})


@query("j3_supply_strain", component("supply_strain"))
def supply_strain(t: Source) -> DataFrame:
    return tidy(filled_rows(t).select(*ROW, risk.supply_strain().alias("raw_supply_strain")), {"raw_supply_strain": 6})


SCALED_COLUMNS = ("scaled_price_gap", "scaled_health_impact", "scaled_supply_strain")


@query("j4_min_max_scale", f"""WITH {SCALED}
SELECT {", ".join(ROW)}, {", ".join(f"{r(c, 6)} AS {c}" for c in SCALED_COLUMNS)} FROM scaled""")
def min_max_scale(t: Source) -> DataFrame:
    rows = stage(index.with_components(filled_rows(t)), "components")
    scaled = index.min_max_scaled(rows, {c.replace("scaled", "raw"): c for c in SCALED_COLUMNS})
    return tidy(scaled.select(*ROW, *SCALED_COLUMNS), dict.fromkeys(SCALED_COLUMNS, 6))


@query("j5_supply_risk_index", f"""WITH {SCALED}
SELECT {", ".join(ROW)}, {r("(scaled_price_gap + scaled_health_impact + scaled_supply_strain) / 3", 6)} AS supply_risk_index FROM scaled""")
def supply_risk_index(t: Source) -> DataFrame:
    rows = stage(index.with_components(filled_rows(t)), "components")
    return index.with_index(rows).select(*ROW, "supply_risk_index")


STAGED = LINES + f""", b AS (
  SELECT id_asal AS id_wilayah, tahun, bulan, CASE p_type WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 2 END AS id_komoditas, l_quantity AS q,
         l_extendedprice AS e, l_returnflag AS f, l_linestatus AS s, l_linenumber AS ln, p_retailprice AS rp,
         CASE WHEN l_orderkey % 20 <> 0 THEN l_extendedprice / l_quantity END AS p
  FROM lines),
price_median AS (
  SELECT id_wilayah, id_komoditas, bulan, quantile_disc(p, 0.5) AS med FROM b WHERE p IS NOT NULL AND id_komoditas IS NOT NULL GROUP BY ALL),
monthly AS (
  SELECT id_wilayah, tahun, bulan, id_komoditas, coalesce(sum(q) FILTER (f = 'R'), 0) AS sum_jumlah_sakit,
         coalesce(sum(q) FILTER (f = 'R' AND s = 'F'), 0) AS sum_jumlah_mati, sum(q) AS sum_vol_mutasi,
         coalesce(sum(e) FILTER (ln = 1), 0) AS sum_realisasi_karkas, avg(coalesce(p, med)) AS avg_harga
  FROM b LEFT JOIN price_median USING (id_wilayah, id_komoditas, bulan) WHERE id_komoditas IS NOT NULL GROUP BY ALL),
seen AS (SELECT DISTINCT id_wilayah, tahun FROM b),
year_sums AS (
  SELECT id_wilayah, tahun, id_komoditas, sum(q) AS q, count(*) AS c, {r("avg(rp)", 2)} AS rp
  FROM b WHERE id_komoditas IS NOT NULL GROUP BY ALL),
annual AS (
  SELECT id_wilayah, tahun, k AS id_komoditas, rp AS harga_baseline,
         CASE WHEN k = 1 AND (id_wilayah + tahun) % 5 = 0 THEN q + 1 ELSE q END AS populasi, CAST(c AS DOUBLE) AS produksi_daging,
         CASE k WHEN 1 THEN 2e0 ELSE 9e0 END AS konsumsi_daging, q / 2 AS permintaan_daging, coalesce(c, 0) * 1e0 AS jumlah_ternak_potong
  FROM (SELECT id_wilayah, tahun, k FROM seen CROSS JOIN (VALUES (1), (2)) v(k))
  LEFT JOIN (SELECT *, id_komoditas AS k FROM year_sums) USING (id_wilayah, tahun, k)),
annual_full AS (
  SELECT id_wilayah, tahun, id_komoditas, harga_baseline,
""" + ",\n".join(
    f"         coalesce({c}, avg({c}) OVER (PARTITION BY id_wilayah, id_komoditas)) AS {c}" for c in ANNUAL_MEASURES
) + """
  FROM annual),
integrated AS (
  SELECT m.*, populasi AS populasi_ternak, harga_baseline,
         produksi_daging * CASE WHEN id_komoditas = 1 THEN 1000 ELSE 1 END / 12 AS avg_produksi_bulanan,
         konsumsi_daging * 1000 * (id_wilayah + 1) / 12 AS avg_konsumsi_bulanan, permintaan_daging / 12 AS avg_permintaan_bulanan,
         jumlah_ternak_potong / 12 AS avg_pemotongan_bulanan, 1000 * (id_wilayah + 1) AS jumlah_penduduk, 1e-2 AS growth_populasi
  FROM monthly m JOIN annual_full USING (id_wilayah, tahun, id_komoditas))"""
STAR_COLUMNS = (
    "nama_provinsi", "nama_komoditas", "tahun", "bulan", "prov_key", "komoditas_key", "jumlah_penduduk", "sum_jumlah_sakit", "sum_jumlah_mati",
    "sum_vol_mutasi", "growth_populasi",
)
STAR_ROUNDED = {
    "sum_realisasi_karkas": 2, "avg_harga": 2, "harga_baseline": 2, "populasi_ternak": 0, "avg_konsumsi_bulanan": 2,
    "avg_pemotongan_bulanan": 2, "avg_permintaan_bulanan": 2, "avg_produksi_bulanan": 2, "supply_risk_index": 5,
}


@query("j6_staging_to_star", on_cube(
    f"SELECT {', '.join(STAR_COLUMNS)}, {', '.join(r(c, d) + f' AS {c}' for c, d in STAR_ROUNDED.items())} FROM cube"
).replace(INTEGRATED, STAGED).replace(
    "SELECT id_komoditas AS komoditas_key, id_komoditas, p_type AS nama_komoditas FROM " + KINDS,
    "SELECT * FROM (VALUES (1, 1, 'Sapi'), (2, 2, 'Ayam')) AS v(komoditas_key, id_komoditas, nama_komoditas)",
))
def staging_to_star(t: Source) -> DataFrame:
    """The whole transform, from raw staging tables to the cube."""
    return tidy(cube_of(build_warehouse(staging(t))).select(*STAR_COLUMNS, *STAR_ROUNDED), STAR_ROUNDED)


@query("j6_fact_build", on_cube("SELECT * FROM cube"))
def fact_build(t: Source) -> DataFrame:
    return cube_of(standin.warehouse(t))
