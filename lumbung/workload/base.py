"""Query registry and the SQL shared by the oracles."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions.numeric import stable_round
from lumbung.plans.standin import COMMODITIES, Source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(source) -> DataFrame`` under a name, with its oracle."""

    def add(fn: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        QUERIES[name] = lambda spark, folder: fn(Source(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tidy(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round result columns, so that summation order does not show."""
    return df.withColumns({c: stable_round(f"`{c}`", d) for c, d in digits.items()})


def n() -> Column:
    return F.count(F.lit(1)).alias("n")


def r(expression: str, digits: int) -> str:
    """The same rounding in SQL."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,{digits + 6})), {digits}) AS DOUBLE)"


def band_sql(value: str, high: float, mid: float) -> str:
    return f"CASE WHEN {value} >= {high} THEN 'BAHAYA' WHEN {value} >= {mid} THEN 'WASPADA' ELSE 'AMAN' END"


# Bands that split the derived index, whose values stay below the usual 0.3 and 0.6.
TEST_BANDS = ((0.12, "BAHAYA"), (0.06, "WASPADA"))

CODE_SQL = "CASE p_type " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in COMMODITIES) + " ELSE 0 END"
KINDS = """(SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS id_komoditas
  FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL))"""
MONTH_NAME_SQL = (
    "list_extract(['Januari','Februari','Maret','April','Mei','Juni','Juli','Agustus','September',"
    "'Oktober','November','Desember'], bulan)"
)

LINES = f"""lines AS (
  SELECT l.*, s_nationkey AS id_asal, c_nationkey AS id_tujuan, part.p_type, p_name, p_retailprice,
         coalesce(kinds.id_komoditas, 0) AS id_komoditas,
         CAST(year(o_orderdate) AS INTEGER) AS tahun, CAST(month(o_orderdate) AS INTEGER) AS bulan
  FROM lineitem l
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN part ON p_partkey = l_partkey
  LEFT JOIN {KINDS} kinds ON kinds.p_type = part.p_type
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey)"""

FLOW = LINES + """, flow AS (
  SELECT id_asal, id_tujuan, tahun, bulan, id_komoditas, count(*) AS n, sum(l_quantity) AS qty,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS qty_sakit,
         sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity END) AS qty_mati,
         sum(l_extendedprice * (1 - l_discount)) AS karkas, sum(l_extendedprice / l_quantity) AS harga,
         sum(p_retailprice) AS dasar
  FROM lines GROUP BY ALL)"""

DIMS = """, dim_prov AS (
  SELECT CAST(row_number() OVER (ORDER BY n_name) AS INTEGER) AS prov_key, n_nationkey AS id_prov,
         n_name AS nama_provinsi FROM nation),
dim_komoditas AS (
  SELECT id_komoditas AS komoditas_key, id_komoditas, p_type AS nama_komoditas FROM """ + KINDS + """),
dim_waktu AS (
  SELECT CAST(row_number() OVER (ORDER BY tahun, bulan) AS INTEGER) AS waktu_key, tahun, bulan,
         CAST(ceil(bulan / 3.0) AS INTEGER) AS kuartal, """ + MONTH_NAME_SQL + """ AS nama_bulan
  FROM (SELECT CAST(unnest(generate_series((SELECT min(year(o_orderdate)) FROM orders),
                                           (SELECT max(year(o_orderdate)) FROM orders))) AS INTEGER) AS tahun) y
  CROSS JOIN (SELECT CAST(unnest(generate_series(1, 12)) AS INTEGER) AS bulan) m)"""

MONTHLY = FLOW + f""", monthly AS (
  SELECT id_asal AS id_wilayah, tahun, bulan, id_komoditas, sum(qty_sakit) AS sum_jumlah_sakit,
         sum(qty_mati) AS sum_jumlah_mati, sum(qty) AS sum_vol_mutasi, {r("sum(karkas)", 2)} AS sum_realisasi_karkas,
         CASE WHEN (id_asal * 7 + tahun * 12 + bulan) % 20 <> 0 THEN sum(harga) / sum(n) END AS avg_harga
  FROM flow GROUP BY id_asal, tahun, bulan, id_komoditas)"""

ANNUAL = MONTHLY + """, supply AS (
  SELECT id_asal AS id_wilayah, tahun, id_komoditas, sum(qty) AS q, sum(karkas) AS k, sum(n) AS c, sum(dasar) AS d
  FROM flow GROUP BY id_asal, tahun, id_komoditas),
demand AS (
  SELECT id_tujuan AS id_wilayah, tahun, id_komoditas, sum(qty) AS w, sum(n) AS m
  FROM flow GROUP BY id_tujuan, tahun, id_komoditas),
annual AS (
  SELECT id_wilayah, tahun, id_komoditas,
         CASE WHEN (id_wilayah * 3 + tahun + id_komoditas) % 20 <> 0 THEN q END AS populasi,
         """ + r("k / 1000", 3) + """ AS produksi_daging, w / m AS konsumsi_daging,
         CASE WHEN (id_wilayah * 3 + tahun + id_komoditas) % 20 <> 7 THEN w END AS permintaan_daging,
         CAST(c AS DOUBLE) AS jumlah_ternak_potong, d / c AS harga_baseline
  FROM supply FULL JOIN demand USING (id_wilayah, tahun, id_komoditas)),
annual_full AS (
  SELECT id_wilayah, tahun, id_komoditas, harga_baseline,
""" + ",\n".join(
    f"         coalesce({c}, avg({c}) OVER (PARTITION BY id_wilayah, id_komoditas)) AS {c}"
    for c in ("populasi", "produksi_daging", "konsumsi_daging", "permintaan_daging", "jumlah_ternak_potong")
) + f"""
  FROM annual),
demography AS (
  SELECT c_nationkey AS id_wilayah, count(*) AS jumlah_penduduk, {r("avg(c_acctbal) / 10000", 6)} AS growth_populasi
  FROM customer GROUP BY c_nationkey),
rates AS (
  SELECT id_wilayah, tahun, id_komoditas, populasi AS populasi_ternak, harga_baseline,
         produksi_daging * CASE WHEN id_komoditas = 1 THEN 1000 ELSE 1 END / 12 AS avg_produksi_bulanan,
         konsumsi_daging * CASE WHEN jumlah_penduduk > 0 THEN jumlah_penduduk ELSE 1 END / 12 AS avg_konsumsi_bulanan,
         permintaan_daging / 12 AS avg_permintaan_bulanan, jumlah_ternak_potong / 12 AS avg_pemotongan_bulanan,
         jumlah_penduduk, growth_populasi
  FROM annual_full LEFT JOIN demography USING (id_wilayah))"""

INTEGRATED = ANNUAL + """, integrated AS (
  SELECT m.id_wilayah, m.tahun, m.bulan, m.id_komoditas, coalesce(sum_jumlah_sakit, 0) AS sum_jumlah_sakit,
         coalesce(sum_jumlah_mati, 0) AS sum_jumlah_mati, coalesce(sum_vol_mutasi, 0) AS sum_vol_mutasi,
         coalesce(sum_realisasi_karkas, 0) AS sum_realisasi_karkas, avg_harga,
         t.* EXCLUDE (id_wilayah, tahun, id_komoditas)
  FROM monthly m JOIN rates t USING (id_wilayah, tahun, id_komoditas))"""

FILLED = INTEGRATED + """, medians AS (
  SELECT id_komoditas, quantile_disc(avg_harga, 0.5) AS med FROM integrated WHERE avg_harga IS NOT NULL GROUP BY 1),
filled AS (
  SELECT i.* EXCLUDE (avg_harga), coalesce(avg_harga, last_value(avg_harga IGNORE NULLS) OVER (
           PARTITION BY id_wilayah, id_komoditas ORDER BY tahun, bulan ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         med) AS avg_harga
  FROM integrated i LEFT JOIN medians USING (id_komoditas))"""


def _component(name: str) -> str:
    low, high = f"coalesce(min({name}) OVER (), 0)", f"coalesce(nullif(max({name}) OVER (), 0), 1)"
    return f"greatest(0, least(1, ({name} - {low}) / coalesce(nullif({high} - {low}, 0), 1)))"


COMPONENTS = FILLED + """, components AS (
  SELECT *,
         CASE WHEN harga_baseline > 0 AND avg_harga IS NOT NULL
              THEN (avg_harga - harga_baseline) / (harga_baseline + 1e-9) ELSE 0 END AS raw_price_gap,
         CASE WHEN populasi_ternak > 0
              THEN (sum_jumlah_sakit + sum_jumlah_mati) / (populasi_ternak + 1e-9) ELSE 0 END AS raw_health_impact,
         CASE WHEN avg_permintaan_bulanan > 0
              THEN sum_vol_mutasi / (avg_permintaan_bulanan + 1e-9) ELSE 0 END AS raw_supply_strain
  FROM filled)"""

SCALED = COMPONENTS + f""", scaled AS (
  SELECT *, {_component("raw_price_gap")} AS scaled_price_gap, {_component("raw_health_impact")} AS scaled_health_impact,
         {_component("raw_supply_strain")} AS scaled_supply_strain
  FROM components)"""

FACT = SCALED + DIMS + f""", fact AS (
  SELECT prov_key, waktu_key, komoditas_key, CAST(jumlah_penduduk AS BIGINT) AS jumlah_penduduk, sum_jumlah_sakit,
         sum_jumlah_mati, sum_vol_mutasi, sum_realisasi_karkas, {r("avg_harga", 2)} AS avg_harga,
         {r("harga_baseline", 2)} AS harga_baseline, {r("populasi_ternak", 0)} AS populasi_ternak,
         {r("avg_konsumsi_bulanan", 2)} AS avg_konsumsi_bulanan, {r("avg_pemotongan_bulanan", 2)} AS avg_pemotongan_bulanan,
         growth_populasi, {r("avg_permintaan_bulanan", 2)} AS avg_permintaan_bulanan,
         {r("avg_produksi_bulanan", 2)} AS avg_produksi_bulanan,
         {r("(scaled_price_gap + scaled_health_impact + scaled_supply_strain) / 3", 6)} AS supply_risk_index
  FROM scaled
  JOIN dim_prov ON id_prov = id_wilayah
  JOIN dim_komoditas USING (id_komoditas)
  JOIN dim_waktu USING (tahun, bulan))"""

CUBE = FACT + """, cube AS (
  SELECT f.*, p.id_prov, p.nama_provinsi, w.tahun, w.bulan, w.kuartal, w.nama_bulan, k.id_komoditas, k.nama_komoditas
  FROM fact f JOIN dim_prov p USING (prov_key) JOIN dim_waktu w USING (waktu_key) JOIN dim_komoditas k USING (komoditas_key))"""


def on_cube(select: str) -> str:
    return f"WITH {CUBE}\n{select}"


def on_lines(select: str) -> str:
    return f"WITH {LINES}\n{select}"
