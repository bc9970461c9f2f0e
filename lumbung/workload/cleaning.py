"""Projections, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import dates, numeric, risk, text
from lumbung.operators import cleaning, dimensions, ranking, star
from lumbung.operators.imputation import fill_with_mean
from lumbung.operators.measures import with_demography
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.plans.warehouse import ANNUAL_MEASURES
from lumbung.session import stage
from lumbung.workload.base import (
    ANNUAL, FACT, LINES, MONTH_NAME_SQL, MONTHLY, TEST_BANDS, band_sql, n, on_cube, on_lines, query, r, tidy,
)


@query("c1_local_numbers", f"""
SELECT o_orderstatus, count(*) AS n, count(v) AS n_read, {r("sum(v)", 2)} AS total FROM (
  SELECT o_orderstatus, CASE WHEN o_orderkey % 20 <> 0 THEN o_totalprice END AS v FROM orders) GROUP BY o_orderstatus""")
def local_numbers(t: Source) -> DataFrame:
    written = "translate(format_number(o_totalprice, 2), ',.', '.,')"
    raw = t("orders").selectExpr("o_orderstatus", f"if(o_orderkey % 20 = 0, 'n/a', {written}) AS v")
    out = cleaning.clean_numbers(raw, ["v"]).groupBy("o_orderstatus").agg(
        n(), F.count("v").alias("n_read"), F.sum("v").alias("total")
    )
    return tidy(out, {"total": 2})


@query("c2_typed_projection", f"""
SELECT l_returnflag, count(*) AS n, count(k) AS n_key, CAST(sum(k) AS BIGINT) AS sum_key, {r("sum(q)", 2)} AS qty FROM (
  SELECT l_returnflag, CASE WHEN l_orderkey % 20 <> 0 THEN l_linenumber END AS k,
         CASE WHEN l_orderkey % 30 <> 0 THEN l_quantity END AS q FROM lineitem) GROUP BY l_returnflag""")
def typed_projection(t: Source) -> DataFrame:
    raw = t("lineitem").selectExpr(
        "l_returnflag", "if(l_orderkey % 20 = 0, 'x', string(l_linenumber)) AS k",
        "if(l_orderkey % 30 = 0, '', string(l_quantity)) AS q",
    )
    out = cleaning.typed(raw, {"k": "int", "q": "double"}).groupBy("l_returnflag").agg(
        n(), F.count("k").alias("n_key"), F.sum("k").alias("sum_key"), F.sum("q").alias("qty")
    )
    return tidy(out, {"qty": 2})


@query("c3_event_dates", """
SELECT CAST(tanggal_tahun AS INTEGER) AS tanggal_tahun, CAST(tanggal_bulan AS INTEGER) AS tanggal_bulan, count(*) AS n FROM (
  SELECT CASE WHEN l_orderkey % 20 = 0 THEN NULL WHEN l_orderkey % 2 = 0 THEN 2000 + year(l_shipdate) % 100
              ELSE year(l_shipdate) END AS tanggal_tahun,
         CASE WHEN l_orderkey % 20 <> 0 THEN month(l_shipdate) END AS tanggal_bulan FROM lineitem)
GROUP BY ALL""")
def event_dates(t: Source) -> DataFrame:
    raw = t("lineitem").selectExpr(
        "CASE WHEN l_orderkey % 20 = 0 THEN 'soon' WHEN l_orderkey % 2 = 0 THEN date_format(l_shipdate, 'MM/dd/yy') "
        "ELSE date_format(l_shipdate, 'MM/dd/yyyy') END AS tanggal"
    )
    return dates.with_event_date(raw, "tanggal").groupBy("tanggal_tahun", "tanggal_bulan").agg(n())


ALIASES = {f"NATION {i}": f"Nation {i:02d}" for i in range(25)} | {f"N{i}": f"Nation {i:02d}" for i in range(25)}


@query("c4_canonical_names", """
SELECT provinsi, count(*) AS n FROM (
  SELECT CASE c_custkey % 4 WHEN 3 THEN n_name ELSE 'Nation ' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS provinsi
  FROM customer JOIN nation ON n_nationkey = c_nationkey) GROUP BY provinsi""")
def canonical_names(t: Source) -> DataFrame:
    raw = t("customer").join(t("nation"), F.expr("n_nationkey = c_nationkey")).selectExpr(
        "CASE c_custkey % 4 WHEN 0 THEN concat('  nation ', n_nationkey) WHEN 1 THEN concat('n', n_nationkey, ' ') "
        "WHEN 2 THEN concat('NATION ', n_nationkey) ELSE n_name END AS provinsi"
    )
    return cleaning.canonical_names(raw, "provinsi", ALIASES).groupBy("provinsi").agg(n())


@query("c5_label_by_content", """
SELECT label, count(*) AS n FROM (SELECT CASE WHEN lower(p_name) LIKE '%ring%' THEN 'Ring'
  WHEN lower(p_name) LIKE '%widget%' THEN 'Widget' ELSE p_name END AS label FROM part) GROUP BY label""")
def label_by_content(t: Source) -> DataFrame:
    label = text.label_by_content(F.initcap("p_name"), {"RING": "Ring", "widget": "Widget"})
    label = F.when(label.isin("Ring", "Widget"), label).otherwise(F.lower(label))
    return t("part").groupBy(label.alias("label")).agg(n())


@query("c6_code_by_name", """
SELECT CASE p_type WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 2 ELSE 0 END AS kode, count(*) AS n,
       CAST(sum(l_linenumber) AS BIGINT) AS s FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def code_by_name(t: Source) -> DataFrame:
    part = t("part").select("p_partkey", text.code_by_name("p_type", {"Small": 1, "large": 2}).alias("kode"))
    rows = t("lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_linenumber").join(part, "p_partkey")
    return rows.groupBy("kode").agg(n(), F.sum("l_linenumber").alias("s"))


@query("c7_normalize_region", """
SELECT nama, count(*) AS n FROM (
  SELECT CASE p_partkey % 4 WHEN 0 THEN 'DI ' WHEN 1 THEN 'DKI ' WHEN 2 THEN 'KEPULAUAN ' ELSE '' END || upper(p_name) AS nama
  FROM part) GROUP BY nama""")
def normalize_region(t: Source) -> DataFrame:
    raw = F.expr(
        "concat(CASE p_partkey % 4 WHEN 0 THEN ' d.i. ' WHEN 1 THEN 'D.K.I. ' "
        "WHEN 2 THEN if(p_partkey % 8 = 2, 'Kep. ', 'Kepulauan Kep. ') ELSE '' END, p_name, '  ')"
    )
    return t("part").groupBy(text.normalize_region(raw).alias("nama")).agg(n())


WORDS = ("ring", "gear", "red ")


@query("c8_keyword_filter", """
SELECT p_name, count(*) AS n FROM part
WHERE p_name LIKE '%ring%' OR p_name LIKE '%gear%' OR p_name LIKE '%red %' GROUP BY p_name""")
def keyword_filter(t: Source) -> DataFrame:
    return t("part").where(text.contains_any(F.upper("p_name"), WORDS)).groupBy("p_name").agg(n())


@query("c9_drop_totals", """
SELECT c_mktsegment, count(*) AS n FROM customer
WHERE c_custkey % 10 NOT IN (0, 1) AND c_custkey % 7 <> 0 GROUP BY c_mktsegment""")
def drop_totals(t: Source) -> DataFrame:
    name = F.expr("CASE c_custkey % 10 WHEN 0 THEN ' INDONESIA' WHEN 1 THEN ' ' ELSE c_name END")
    code = F.expr("CASE WHEN c_custkey % 14 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '' ELSE string(c_nationkey) END")
    return t("customer").where(text.is_real_region(name, code)).groupBy("c_mktsegment").agg(n())


@query("c10_drop_empty_repeated", """
SELECT l_suppkey, count(*) AS n, count(q) AS n_q, count(d) AS n_d FROM (
  SELECT DISTINCT l_suppkey, CASE WHEN l_orderkey % 3 <> 0 THEN l_quantity END AS q,
         CASE WHEN l_orderkey % 4 <> 0 THEN l_discount END AS d FROM lineitem)
WHERE q IS NOT NULL OR d IS NOT NULL GROUP BY l_suppkey""")
def drop_empty_repeated(t: Source) -> DataFrame:
    raw = t("lineitem").selectExpr(
        "l_suppkey", "if(l_orderkey % 3 <> 0, l_quantity, NULL) AS q", "if(l_orderkey % 4 <> 0, l_discount, NULL) AS d"
    )
    kept = cleaning.drop_empty_and_repeated(raw, ["q", "d"])
    return kept.groupBy("l_suppkey").agg(n(), F.count("q").alias("n_q"), F.count("d").alias("n_d"))


@query("c11_zero_if_null", f"""WITH {MONTHLY}
SELECT id_wilayah, tahun, bulan, id_komoditas, coalesce(sum_jumlah_sakit, 0) AS sum_jumlah_sakit,
       coalesce(sum_jumlah_mati, 0) AS sum_jumlah_mati FROM monthly""")
def zero_if_null(t: Source) -> DataFrame:
    sums = standin.lines(t).groupBy(F.col("id_asal").alias("id_wilayah"), "tahun", "bulan", "id_komoditas").agg(
        F.expr(f"sum({standin.RETURNED}) AS sum_jumlah_sakit"),
        F.expr(f"sum({standin.RETURNED_FINISHED}) AS sum_jumlah_mati"),
    )
    return cleaning.zero_if_null(sums, ["sum_jumlah_sakit", "sum_jumlah_mati"])


@query("c12_known_commodities", on_lines("""
SELECT id_komoditas, count(*) AS n FROM lines WHERE id_komoditas IN (1, 2) GROUP BY id_komoditas"""))
def known_commodities(t: Source) -> DataFrame:
    rows = standin.lines(t, month=False, origin=False)
    return cleaning.keep_known(rows, "id_komoditas", [1, 2]).groupBy("id_komoditas").agg(n())


RATE_COLUMNS = ("avg_produksi_bulanan", "avg_konsumsi_bulanan", "avg_permintaan_bulanan", "avg_pemotongan_bulanan")


@query("c13_monthly_rates", f"""WITH {ANNUAL}
SELECT id_wilayah, tahun, id_komoditas, {", ".join(f"{r(c, 4)} AS {c}" for c in RATE_COLUMNS)} FROM rates""")
def monthly_rates(t: Source) -> DataFrame:
    flows = standin.flow(t)
    stats = fill_with_mean(standin.annual(flows), ["id_wilayah", "id_komoditas"], ANNUAL_MEASURES)
    out = cleaning.monthly_rates(with_demography(stats, standin.demography(t), ["id_wilayah"]))
    return tidy(out, dict.fromkeys(RATE_COLUMNS, 4)).select("id_wilayah", "tahun", "id_komoditas", *RATE_COLUMNS)


@query("c14_output_rounding", f"""WITH {LINES}
SELECT id_asal, id_komoditas, {r("avg(l_extendedprice / l_quantity)", 2)} AS avg_harga,
       {r("avg(p_retailprice)", 2)} AS harga_baseline, {r("avg(l_quantity)", 0)} AS populasi_ternak,
       CAST(trunc({r("sum(l_tax)", 6)}) AS BIGINT) AS jumlah_penduduk FROM lines GROUP BY ALL""")
def output_rounding(t: Source) -> DataFrame:
    out = standin.lines(t, month=False).groupBy("id_asal", "id_komoditas").agg(
        F.expr(f"avg({standin.UNIT_PRICE}) AS avg_harga"), F.avg("p_retailprice").alias("harga_baseline"),
        F.avg("l_quantity").alias("populasi_ternak"), numeric.stable_round(F.sum("l_tax"), 6).alias("jumlah_penduduk"),
    )
    others = [c for c in cleaning.ROUNDING if c not in out.columns]
    return cleaning.round_outputs(out.withColumns({c: F.lit(0.0) for c in others})).drop(*others)


@query("c15_align_schema", f"""WITH {FACT}
SELECT prov_key, waktu_key, komoditas_key, supply_risk_index, avg_produksi_bulanan,
       CAST(NULL AS DOUBLE) AS growth_populasi, CAST(jumlah_penduduk AS BIGINT) AS jumlah_penduduk FROM fact""")
def align_schema(t: Source) -> DataFrame:
    fact = standin.warehouse(t)["fact_supply_resilience"]
    raw = fact.withColumnRenamed("avg_produksi_bulanan", "avg_produksi").drop("growth_populasi")
    wanted = ("prov_key", "waktu_key", "komoditas_key", "supply_risk_index", "avg_produksi_bulanan", "growth_populasi", "jumlah_penduduk")
    return star.align(raw, {c: star.FACT_TYPES[c] for c in wanted})


@query("c16_alert_status", on_cube(f"""
SELECT {band_sql("supply_risk_index", 0.12, 0.06)} AS status, {band_sql("supply_risk_index", 0.6, 0.3)} AS status_baku,
       count(*) AS n FROM cube GROUP BY ALL"""))
def alert_status(t: Source) -> DataFrame:
    return standin.cube(t).groupBy(
        risk.band("supply_risk_index", TEST_BANDS).alias("status"), risk.band("supply_risk_index").alias("status_baku")
    ).agg(n())


@query("c17_notebook_zones", on_cube(f"""
SELECT {band_sql("supply_risk_index", 0.1, 0.06)} AS zona, {band_sql("supply_risk_index", 0.5, 0.3)} AS zona_baku,
       CASE WHEN supply_risk_index > 0.09 THEN 'BAHAYA' ELSE 'AMAN' END AS label, count(*) AS n FROM cube GROUP BY ALL"""))
def notebook_zones(t: Source) -> DataFrame:
    return standin.cube(t).groupBy(
        risk.band("supply_risk_index", ((0.1, "BAHAYA"), (0.06, "WASPADA"))).alias("zona"),
        risk.band("supply_risk_index", risk.NOTEBOOK_BANDS).alias("zona_baku"),
        risk.above("supply_risk_index", 0.09).alias("label"),
    ).agg(n())


@query("c18_global_filter", on_cube("""
SELECT nama_provinsi, bulan, nama_komoditas, supply_risk_index FROM cube
WHERE nama_komoditas = 'SMALL' AND tahun = 1997"""))
def global_filter(t: Source) -> DataFrame:
    rows = cleaning.global_filter(standin.cube(t), nama_komoditas="SMALL", tahun=1997, nama_provinsi="Semua")
    return rows.select("nama_provinsi", "bulan", "nama_komoditas", "supply_risk_index")


@query("c19_period_labels", """
SELECT tahun || '/' || lpad(CAST(bulan AS VARCHAR), 2, '0') AS garis, tahun || '-' || lpad(CAST(bulan AS VARCHAR), 2, '0') AS strip,
       tahun || ' Q' || CAST(ceil(bulan / 3.0) AS INTEGER) AS kuartal, CAST(tahun * 100 + bulan AS INTEGER) AS angka,
       tahun || '-' || lpad(CAST(bulan AS VARCHAR), 2, '0') || '-01' AS awal, count(*) AS n
FROM (SELECT year(o_orderdate) AS tahun, month(o_orderdate) AS bulan FROM orders) GROUP BY ALL""")
def period_labels(t: Source) -> DataFrame:
    y, m = F.col("tahun"), F.col("bulan")
    months = t("orders").groupBy(F.year("o_orderdate").alias("tahun"), F.month("o_orderdate").alias("bulan")).agg(n())
    return months.select(
        dates.period_slash(y, m).alias("garis"), dates.period_dash(y, m).alias("strip"),
        dates.period_quarter(y, dates.quarter_of(m)).alias("kuartal"), dates.period_number(y, m).alias("angka"),
        dates.month_start(y, m).cast("string").alias("awal"), "n",
    )


@query("c20_filter_choices", on_lines("""
SELECT 'tahun' AS filter, CAST(tahun AS VARCHAR) AS pilihan FROM lines GROUP BY tahun
UNION ALL SELECT 'provinsi', n_name FROM lines JOIN nation ON n_nationkey = id_asal GROUP BY n_name"""))
def filter_choices(t: Source) -> DataFrame:
    pairs = standin.lines(t, commodity=False).select("tahun", "id_asal").distinct()
    rows = stage(pairs.join(t("nation"), F.expr("n_nationkey = id_asal")), "pairs")
    years = ranking.choices(rows, "tahun", descending=True).select(F.lit("tahun").alias("filter"), F.col("tahun").cast("string").alias("pilihan"))
    names = ranking.choices(rows, "n_name").select(F.lit("provinsi").alias("filter"), F.col("n_name").alias("pilihan"))
    return years.unionByName(names)


@query("c21_default_selection", """
SELECT 'known' AS kasus, n_name FROM nation WHERE n_name IN ('NATION_3', 'NATION_7')
UNION ALL SELECT 'unknown', n_name FROM (SELECT n_name FROM nation ORDER BY n_name LIMIT 3)""")
def default_selection(t: Source) -> DataFrame:
    served = t("customer").join(t("nation"), F.expr("n_nationkey = c_nationkey")).select("n_name")
    known = t.spark.createDataFrame([("NATION_3",), ("NATION_7",), ("ATLANTIS",)], "n_name string")
    unknown = t.spark.createDataFrame([("ATLANTIS",)], "n_name string")
    parts = [
        ranking.default_selection(served, chosen).select(F.lit(case).alias("kasus"), "n_name")
        for case, chosen in (("known", known), ("unknown", unknown))
    ]
    return parts[0].unionByName(parts[1])


@query("c22_calendar_attributes", f"""
SELECT tahun, bulan, CAST(ceil(bulan / 3.0) AS INTEGER) AS kuartal, {MONTH_NAME_SQL} AS nama_bulan, n FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS tahun, CAST(month(o_orderdate) AS INTEGER) AS bulan, count(*) AS n
  FROM orders GROUP BY ALL)""")
def calendar_attributes(t: Source) -> DataFrame:
    months = t("orders").groupBy(F.year("o_orderdate").alias("tahun"), F.month("o_orderdate").alias("bulan")).agg(n())
    return dimensions.calendar_attributes(months)


REGION_CODES = {f"NATION_{i}": f"{11 + i}" for i in range(20)}


@query("c23_official_codes", """
SELECT n_name, CASE WHEN n_nationkey < 20 THEN CAST(11 + n_nationkey AS VARCHAR) END AS kode_bps, count(*) AS n
FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""")
def official_codes(t: Source) -> DataFrame:
    counts = t("customer").join(t("nation"), F.expr("n_nationkey = c_nationkey")).groupBy("n_name").agg(n())
    return dimensions.with_code(counts, "n_name", REGION_CODES).select("n_name", "kode_bps", "n")
