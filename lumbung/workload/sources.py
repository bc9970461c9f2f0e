"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import text
from lumbung.operators import dimensions, star
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.plans.warehouse import cube_of, load_warehouse, read_warehouse
from lumbung.session import stage, stage_path
from lumbung.sources import indicators, readers, sinks
from lumbung.sources.fixed_values import ATTRIBUTE_TYPES, FACT_TYPES
from lumbung.workload.base import CODE_SQL, DIMS, FACT, on_cube, on_lines, query, r, tidy

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def counts_sql(tables) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in tables)


@query("a1_scan_counts", counts_sql(TABLES))
def scan_counts(t: Source) -> DataFrame:
    return sinks.row_counts({name: readers.read_staging(t.spark, t.folder, name) for name in TABLES})


@query("a2_lower_case_parquet", f"""
SELECT o_orderstatus, count(*) AS n, {r("sum(o_totalprice)", 2)} AS total FROM orders GROUP BY o_orderstatus""")
def lower_case_parquet(t: Source) -> DataFrame:
    folder = stage_path(t.spark, "upper")
    orders = t("orders")
    orders.toDF(*[c.upper() for c in orders.columns]).write.parquet(f"{folder}/orders")
    back = readers.read_parquet(t.spark, folder, "orders")
    return tidy(
        back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")),
        {"total": 2},
    )


SUBSELECT = """
SELECT c.c_mktsegment, o.o_orderstatus, count(*) AS n, count(DISTINCT o.o_custkey) AS n_customers
FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
GROUP BY c.c_mktsegment, o.o_orderstatus"""


@query("a3_sub_select", SUBSELECT.format(orders="orders", customer="customer"))
def sub_select(t: Source) -> DataFrame:
    return readers.sql_query(t.spark, SUBSELECT, {"orders": t("orders"), "customer": t("customer")})


CUBE_COLUMNS = ", ".join(
    c if c != "nama_provinsi" else "upper(trim(nama_provinsi)) AS nama_provinsi" for c in FACT_TYPES | ATTRIBUTE_TYPES
)


@query("a4_cube_csv", on_cube(f"SELECT {CUBE_COLUMNS} FROM cube"))
def cube_csv(t: Source) -> DataFrame:
    path = stage_path(t.spark, "cube-csv")
    sinks.export_cube(standin.cube(t), path)
    return readers.read_cube_csv(t.spark, path)


def payloads(t: Source) -> DataFrame:
    """One JSON document per year, shaped as the statistics office delivers them.

    A document lists the regions, so its size is that of the region dimension.
    """
    small = standin.lines(t).groupBy("id_asal", "tahun", "id_komoditas", "p_type").agg(F.sum("l_quantity").alias("q"))
    entry = F.struct(
        F.concat(F.lit("v"), F.col("id_komoditas").cast("string")).alias("key"),
        F.struct(F.col("q").cast("bigint").cast("string").alias("value_raw")).alias("value"),
    )
    region = small.groupBy("tahun", "id_asal").agg(F.map_from_entries(F.collect_list(entry)).alias("variables"))
    region = region.join(t("nation"), F.col("n_nationkey") == F.col("id_asal")).select(
        "tahun", F.expr("concat(' ', n_name)").alias("label"), F.expr("lpad(string(n_nationkey + 1), 7, '0')").alias("kode_wilayah"),
        "variables",
    )
    nothing = "map('v1', named_struct('value_raw', '-1'))"
    extra = region.select("tahun").distinct().selectExpr(
        "tahun",
        f"inline(array(named_struct('label', 'Indonesia', 'kode_wilayah', '0000000', 'variables', {nothing}), "
        f"named_struct('label', 'no code', 'kode_wilayah', '', 'variables', {nothing})))",
    )
    names = small.select(
        "tahun", F.expr("concat('v', id_komoditas)").alias("key"),
        F.struct(F.expr("concat('Jumlah ', p_type, ' Terjual')").alias("nama_variabel")).alias("value"),
    ).distinct()
    names = names.groupBy("tahun").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("columns"))
    rows = region.unionByName(extra).groupBy("tahun").agg(
        F.collect_list(F.struct("label", "kode_wilayah", "variables")).alias("data")
    )
    page = F.struct(F.lit(None).cast("map<string,struct<nama_variabel:string>>").alias("kolom"),
                    F.lit(None).cast("array<struct<label:string,kode_wilayah:string,variables:map<string,struct<value_raw:string>>>>").alias("data"))
    table = F.struct(F.col("columns").alias("kolom"), F.col("data"))
    return rows.join(names, "tahun").select("tahun", F.to_json(F.struct(F.lit("OK").alias("status"), F.array(page, table).alias("data"))).alias("payload"))


@query("a5_indicator_payload", on_lines("""
SELECT n_name AS provinsi, tahun, sum(CASE WHEN p_type = 'SMALL' THEN l_quantity END) AS terjual
FROM lines JOIN nation ON n_nationkey = id_asal GROUP BY n_name, tahun"""))
def indicator_payload(t: Source) -> DataFrame:
    parsed = indicators.parse_indicator(payloads(t), ["jumlah", "small"], "terjual")
    return parsed.withColumn("terjual", F.col("terjual").try_cast("double"))


STATISTICS = {"terjual_small": ["jumlah", "small"], "terjual_large": ["jumlah", "large"]}


@query("a5_annual_statistics", on_lines("""
SELECT n_name AS provinsi, tahun, sum(CASE WHEN p_type = 'SMALL' THEN l_quantity END) AS terjual_small,
       sum(CASE WHEN p_type = 'LARGE' THEN l_quantity END) AS terjual_large
FROM lines JOIN nation ON n_nationkey = id_asal GROUP BY n_name, tahun HAVING terjual_small IS NOT NULL OR terjual_large IS NOT NULL"""))
def annual_statistics(t: Source) -> DataFrame:
    """Two indicators, each with an unusable document before the good one."""
    good = stage(payloads(t), "payloads")
    documents = good.select("tahun", F.lit(2).alias("urutan"), "payload").unionByName(
        good.select("tahun", F.lit(1).alias("urutan"), F.lit('{"status": "ERROR"}').alias("payload"))
    )
    documents = documents.select("*", F.explode(F.array(*[F.lit(c) for c in STATISTICS])).alias("indikator"))
    table = indicators.annual_statistics(documents, STATISTICS)
    table = table.select("provinsi", "tahun", *[F.col(c).try_cast("double").alias(c) for c in STATISTICS])
    return table.where(" OR ".join(f"{c} IS NOT NULL" for c in STATISTICS))


@query("a5_region_indicator", on_lines("""
SELECT ' ' || n_name AS provinsi, tahun, lpad(CAST(n_nationkey + 1 AS VARCHAR), 7, '0') AS kode_wilayah,
       sum(CASE WHEN p_type = 'SMALL' THEN l_quantity END) AS terjual
FROM lines JOIN nation ON n_nationkey = id_asal GROUP BY n_name, n_nationkey, tahun"""))
def region_indicator(t: Source) -> DataFrame:
    """The document of a year delivered once per region, each read for its own region."""
    regions = standin.lines(t).select("id_asal", "tahun").distinct().join(t("nation"), F.expr("n_nationkey = id_asal"))
    documents = regions.select("tahun", F.concat(F.lit(" "), "n_name").alias("provinsi")).join(payloads(t), "tahun")
    parsed = indicators.parse_region_indicator(documents, ["jumlah", "small"], "terjual")
    return parsed.withColumn("terjual", F.col("terjual").try_cast("double"))


@query("a5_json_props", f"""
SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n, {r("sum(value)", 2)} AS total
FROM events GROUP BY 1""")
def json_props(t: Source) -> DataFrame:
    parsed = t("events").select(F.from_json("props", "k int")["k"].alias("k"), "value")
    return tidy(parsed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), {"total": 2})


PRIORITY = ("purchase", "signup", "click", "view", "error")


@query("a6_first_valid_source", f"""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
         ORDER BY coalesce(nullif(list_position({list(PRIORITY)}, event_type), 0), {len(PRIORITY) + 1}), event_id) AS rn FROM events) WHERE rn = 1""")
def first_valid_source(t: Source) -> DataFrame:
    place = F.nullif(F.array_position(F.array(*[F.lit(p) for p in PRIORITY]), F.col("event_type")), F.lit(0))
    place = F.coalesce(place, F.lit(len(PRIORITY) + 1))  # unlisted types come last
    return indicators.first_valid(
        t("events"), ["user_id"], [place, F.col("event_id")], ["event_type", "event_id", "value"]
    )


@query("a7_unpivot_price_sheet", f"""
SELECT 'TIMUR' AS provinsi, 'KOTA' AS kota, o_orderpriority AS jenis_daging, 'PASAR' AS jenis_pasar,
       {r("sum(o_totalprice)", 2)} AS harga, CAST(strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS VARCHAR) AS tanggal
FROM orders WHERE lower(o_orderpriority) LIKE '%high%' OR lower(o_orderpriority) LIKE '%urgent%' OR lower(o_orderpriority) LIKE '%low%'
GROUP BY o_orderpriority, date_trunc('month', o_orderdate)""")
def unpivot_price_sheet(t: Source) -> DataFrame:
    header = F.date_format("o_orderdate", "'01/ 'MM'/ 'yyyy")
    sheet = t("orders").select(F.col("o_orderpriority").alias("Komoditas (Rp)"), header.alias("h"), "o_totalprice")
    months = sorted(row.h for row in sheet.where("h IS NOT NULL").select("h").distinct().collect())  # a sheet's header
    sheet = sheet.groupBy("Komoditas (Rp)").pivot("h", months).agg(F.sum("o_totalprice"))
    long = readers.unpivot_price_sheet(sheet, F.lit("TIMUR"), F.lit("PASAR"), F.lit("KOTA"), ["high", "urgent", "low"])
    long = long.select("provinsi", "kota", "jenis_daging", "jenis_pasar", "harga", F.expr("date_format(waktu, 'yyyy-MM-dd') AS tanggal"))
    return tidy(long.where("harga IS NOT NULL"), {"harga": 2})


@query("a7_price_sheet_files", f"""
SELECT o_orderstatus AS provinsi, o_orderpriority AS jenis_daging, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS tanggal,
       {r("sum(o_totalprice)", 2)} AS harga
FROM orders WHERE lower(o_orderpriority) LIKE '%high%' OR lower(o_orderpriority) LIKE '%low%' GROUP BY ALL""")
def price_sheet_files(t: Source) -> DataFrame:
    """A CSV sheet per status, in a folder of its name, all read in one call."""
    folder = stage_path(t.spark, "sheets")
    rows = t("orders").where("o_orderdate IS NOT NULL").select(
        "o_orderstatus", F.col("o_orderpriority").alias("Komoditas (Rp)"), F.date_format("o_orderdate", "'01/ 'MM'/ 'yyyy").alias("h"), "o_totalprice"
    )
    months = sorted(row.h for row in rows.select("h").distinct().collect())
    wide = stage(rows.groupBy("o_orderstatus", "Komoditas (Rp)").pivot("h", months).agg(F.sum("o_totalprice")), "sheets")
    # Folders are named o_orderstatus=<status>; the reader takes the name of the folder as the region.
    wide.repartition("o_orderstatus").write.partitionBy("o_orderstatus").csv(folder, header=True)
    long = readers.read_price_sheets(t.spark, folder, ["high", "low"]).where("harga IS NOT NULL")
    status = F.element_at(F.split("provinsi", "="), -1).alias("provinsi")
    return tidy(long.select(status, "jenis_daging", F.date_format("waktu", "yyyy-MM-dd").alias("tanggal"), "harga"), {"harga": 2})


@query("a7_mixed_sheets", f"""
SELECT o_orderstatus AS provinsi, o_orderpriority AS jenis_daging, strftime(o_orderdate, '%Y-%m-%d') AS tanggal,
       {r("sum(o_totalprice)", 2)} AS harga
FROM orders WHERE lower(o_orderpriority) LIKE '%high%' OR lower(o_orderpriority) LIKE '%low%' GROUP BY ALL""")
def mixed_sheets(t: Source) -> DataFrame:
    """A CSV sheet per status and month with the days of its month as columns, all read in one scan."""
    folder = stage_path(t.spark, "sheets")
    rows = t("orders").where("o_orderdate IS NOT NULL").selectExpr(
        "o_orderstatus", "date_format(o_orderdate, 'yyyy-MM') AS bulan", "o_orderpriority", "cast(o_orderdate AS date) AS hari", "o_totalprice"
    )
    sums = rows.groupBy("o_orderstatus", "bulan", "o_orderpriority", "hari").agg(F.sum("o_totalprice").alias("q"))
    lines = sums.groupBy("o_orderstatus", "bulan", "o_orderpriority").agg(
        F.map_from_entries(F.collect_list(F.struct("hari", "q"))).alias("cells")
    )
    sheets = lines.groupBy("o_orderstatus", "bulan").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.map_keys("cells"))))).alias("days"),
        F.collect_list(F.struct("o_orderpriority", "cells")).alias("lines"),
    )
    header = F.concat(F.lit('No,"Komoditas (Rp)",'), F.array_join(F.transform("days", lambda d: F.date_format(d, "dd/ MM/ yyyy")), ","))
    values = lambda x: F.array_join(F.transform("days", lambda d: F.coalesce(x["cells"][d].cast("string"), F.lit(""))), ",")
    body = F.transform("lines", lambda x: F.concat(F.lit('1,"'), x["o_orderpriority"], F.lit('",'), values(x)))
    text_ = F.array_join(F.concat(F.array(header), body), "\n")
    sheets.select("o_orderstatus", "bulan", text_.alias("value")).write.partitionBy("bulan", "o_orderstatus").text(folder)
    long = readers.read_mixed_price_sheets(t.spark, folder, ["high", "low"]).where("harga IS NOT NULL")
    status = F.element_at(F.split("provinsi", "="), -1).alias("provinsi")
    return tidy(long.select(status, "jenis_daging", F.date_format("waktu", "yyyy-MM-dd").alias("tanggal"), "harga"), {"harga": 2})


@query("a8_label_parts", """
SELECT jenis_pasar, kota, count(*) AS n FROM (
  SELECT CASE WHEN p_partkey % 10 = 0 THEN 'TIDAK DIKETAHUI' ELSE split_part(p_name, ' ', 1) END AS jenis_pasar,
         CASE WHEN p_partkey % 10 = 0 THEN replace(p_name, ' ', '') ELSE split_part(p_name, ' ', 2) END AS kota FROM part)
GROUP BY ALL""")
def label_parts(t: Source) -> DataFrame:
    path = F.expr(
        "concat('/data/prices/', CASE WHEN p_partkey % 10 = 0 THEN replace(p_name, ' ', '') ELSE replace(p_name, ' ', '_') END, '.xlsx')"
    )
    market, city = text.split_label(text.file_label(path))
    return t("part").select(market.alias("jenis_pasar"), city.alias("kota")).groupBy("jenis_pasar", "kota").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("a9_union_files", f"""
SELECT jenis_pasar, count(*) AS n, count(harga) AS n_harga, {r("sum(harga)", 2)} AS total, count(waktu) AS n_waktu,
       strftime(max(waktu), '%Y-%m-%d') AS terakhir FROM (
  SELECT o_orderpriority AS jenis_pasar, CASE WHEN o_orderkey % 20 <> 0 THEN o_totalprice END AS harga,
         CASE WHEN o_orderkey % 30 <> 0 THEN o_orderdate END AS waktu FROM orders) GROUP BY jenis_pasar""")
def union_files(t: Source) -> DataFrame:
    raw = [t("orders").where(f"o_orderdate {when}").selectExpr(
        "'X' AS provinsi", "'Y' AS kota", "o_orderstatus AS jenis_daging", "o_orderpriority AS jenis_pasar",
        "CASE WHEN o_orderkey % 20 = 0 THEN '-' ELSE string(o_totalprice) END AS harga",
        "CASE WHEN o_orderkey % 30 = 0 THEN 'soon' ELSE string(o_orderdate) END AS waktu",
    ) for when in ("< DATE'1998-01-01'", ">= DATE'1998-01-01'", "IS NULL")]
    out = readers.union_files(raw).groupBy("jenis_pasar").agg(
        F.count(F.lit(1)).alias("n"), F.count("harga").alias("n_harga"), F.sum("harga").alias("total"),
        F.count("waktu").alias("n_waktu"), F.date_format(F.max("waktu"), "yyyy-MM-dd").alias("terakhir"),
    )
    return tidy(out, {"total": 2})


@query("a10_snapshot_copy", counts_sql(TABLES))
def snapshot_copy(t: Source) -> DataFrame:
    folder = stage_path(t.spark, "snapshot")
    outcome = sinks.snapshot({name: t(name) for name in TABLES}, folder)
    return sinks.row_counts({name: t.spark.read.parquet(f"{folder}/{name}") for name, failed in outcome.items() if not failed})


@query("a11_literal_table", f"""
SELECT {CODE_SQL} AS komoditas_key, p_type AS nama_komoditas, count(*) AS n FROM part GROUP BY ALL""")
def literal_table(t: Source) -> DataFrame:
    codes = dimensions.commodity_dimension(t.spark, standin.COMMODITIES)
    return t("part").groupBy(F.col("p_type").alias("nama_komoditas")).agg(F.count(F.lit(1)).alias("n")).join(
        codes, "nama_komoditas", "left"
    ).select(F.coalesce("komoditas_key", F.lit(0)).alias("komoditas_key"), "nama_komoditas", "n")


@query("a12_month_spine", f"""WITH {DIMS.lstrip(', ')} SELECT tahun, bulan FROM dim_waktu""")
def month_spine(t: Source) -> DataFrame:
    years = t("orders").agg(F.year(F.min("o_orderdate")).alias("first"), F.year(F.max("o_orderdate")).alias("last"))
    return dimensions.month_spine(years)


@query("b1_save_parquet", f"""WITH {FACT}
SELECT replace(table_name, 'fact', 'fact_supply_resilience') AS table_name, n_rows, keys FROM (
  SELECT 'dim_prov' AS table_name, count(*) AS n_rows, CAST(sum(prov_key) AS BIGINT) AS keys FROM dim_prov
  UNION ALL SELECT 'dim_komoditas', count(*), CAST(sum(komoditas_key) AS BIGINT) FROM dim_komoditas
  UNION ALL SELECT 'dim_waktu', count(*), CAST(sum(waktu_key) AS BIGINT) FROM dim_waktu
  UNION ALL SELECT 'fact', count(*), CAST(sum(prov_key) AS BIGINT) FROM fact)""")
def save_parquet(t: Source) -> DataFrame:
    tables = standin.warehouse(t)
    years = tables["dim_waktu"].select("waktu_key", "tahun")
    folder = stage_path(t.spark, "output")
    sinks.save_parquet({**tables, sinks.FACT: tables[sinks.FACT].join(years, "waktu_key")}, folder)
    key = {"dim_prov": "prov_key", "dim_komoditas": "komoditas_key", "dim_waktu": "waktu_key", sinks.FACT: "prov_key"}
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(key[name]).alias("keys"))
        .select(F.lit(name).alias("table_name"), "n_rows", "keys")
        for name, df in sinks.read_back(t.spark, folder, list(tables)).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("b2_load_dimensions", f"""WITH {DIMS.lstrip(', ')}
SELECT 'dim_prov' AS table_name, count(*) AS n_rows FROM dim_prov
UNION ALL SELECT 'dim_komoditas', count(*) FROM dim_komoditas UNION ALL SELECT 'dim_waktu', count(*) FROM dim_waktu""")
def load_dimensions(t: Source) -> DataFrame:
    folder = stage_path(t.spark, "dims")
    return sinks.row_counts({
        name: sinks.load_table(df, folder, name, star.DIMENSION_COLUMNS[name])
        for name, df in standin.dims_of(t).items()
    })


@query("b3_load_fact", f"""WITH {FACT}
SELECT count(*) AS n_rows, {r("sum(supply_risk_index)", 4)} AS sum_risk, count(avg_harga) AS n_harga FROM fact""")
def load_fact(t: Source) -> DataFrame:
    loaded = load_warehouse(standin.warehouse(t), stage_path(t.spark, "dwh"))
    out = loaded[sinks.FACT].agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("supply_risk_index").alias("sum_risk"), F.count("avg_harga").alias("n_harga")
    )
    return tidy(out, {"sum_risk": 4})


VERSION_SQL = f"count(*) AS n_rows, {r('sum(supply_risk_index)', 4)} AS sum_risk, count(DISTINCT waktu_key) AS n_months"


@query("b3_versioned_load", f"""WITH {FACT}
SELECT 1 AS versi, {VERSION_SQL} FROM fact WHERE komoditas_key <> 2 UNION ALL SELECT 2, {VERSION_SQL} FROM fact
UNION ALL SELECT 0, {VERSION_SQL} FROM fact""")
def versioned_load(t: Source) -> DataFrame:
    """Two loads into one folder; the current version (0 here) and both by their number, all through pointers."""
    folder, star_ = stage_path(t.spark, "dwh"), standin.warehouse(t)
    star_[sinks.FACT] = stage(star_[sinks.FACT], "fact")
    load_warehouse({**star_, sinks.FACT: star_[sinks.FACT].where("komoditas_key <> 2")}, folder)
    load_warehouse(star_, folder)
    parts = [
        read_warehouse(t.spark, folder, number)[sinks.FACT].agg(
            F.lit(number or 0).alias("versi"), F.count(F.lit(1)).alias("n_rows"), F.sum("supply_risk_index").alias("sum_risk"),
            F.count_distinct("waktu_key").alias("n_months"),
        )
        for number in (1, 2, None)
    ]
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]), {"sum_risk": 4})


@query("b4_export_cube", on_cube(f"""
SELECT tahun, count(*) AS n, {r("sum(supply_risk_index)", 4)} AS sum_risk FROM cube GROUP BY tahun"""))
def export_cube(t: Source) -> DataFrame:
    path = stage_path(t.spark, "export")
    sinks.export_cube(cube_of(standin.warehouse(t)), path)
    back = readers.read_cube_csv(t.spark, path).groupBy("tahun").agg(
        F.count(F.lit(1)).alias("n"), F.sum("supply_risk_index").alias("sum_risk")
    )
    return tidy(back, {"sum_risk": 4})


@query("b5_export_prices", f"""
SELECT o_orderpriority AS jenis_daging, count(*) AS n, {r("sum(o_totalprice)", 2)} AS total FROM orders GROUP BY 1""")
def export_prices(t: Source) -> DataFrame:
    path = stage_path(t.spark, "prices")
    prices = t("orders").selectExpr(
        "'X' AS provinsi", "'Y' AS kota", "o_orderpriority AS jenis_daging", "o_orderstatus AS jenis_pasar",
        "o_totalprice AS harga", "o_orderdate AS waktu",
    )
    sinks.export_prices(prices, path)
    schema = "provinsi string, kota string, jenis_daging string, jenis_pasar string, harga double, waktu timestamp_ntz"
    back = t.spark.read.schema(schema).csv(path, header=True).groupBy("jenis_daging").agg(
        F.count(F.lit(1)).alias("n"), F.sum("harga").alias("total")
    )
    return tidy(back, {"total": 2})
