"""Set operations, pivots and unpivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import dates
from lumbung.operators import reshape, rollups
from lumbung.plans import result_sets, standin
from lumbung.plans.standin import Source
from lumbung.workload.aggregates import GAPS
from lumbung.workload.base import CUBE, n, on_cube, on_lines, query, r, tidy


@query("h1_union_by_name", """
SELECT p_type, count(*) AS n, sum(l_quantity) AS qty FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE p_type IN ('SMALL', 'LARGE') GROUP BY p_type""")
def union_by_name(t: Source) -> DataFrame:
    small = t("part").where("p_type = 'SMALL'").selectExpr("p_type", "p_partkey AS l_partkey")
    large = t("part").where("p_type = 'LARGE'").selectExpr("p_partkey AS l_partkey", "p_type")
    rows = t("lineitem").join(reshape.stack([small, large]), "l_partkey")
    return rows.groupBy("p_type").agg(n(), F.sum("l_quantity").alias("qty"))


@query("h2_bind_rows", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS tahun, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY 1""")
def bind_rows(t: Source) -> DataFrame:
    slices = [
        t("lineitem").where(f"l_shipdate {when}").selectExpr("year(l_shipdate) AS tahun", "l_quantity")
        for when in ("< DATE'1998-01-01'", ">= DATE'1998-01-01'", "IS NULL")
    ]
    return reshape.stack(slices).groupBy("tahun").agg(n(), F.sum("l_quantity").alias("qty"))


@query("h3_distinct", """
SELECT DISTINCT n_name, o_orderpriority FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def distinct(t: Source) -> DataFrame:
    orders = t("orders").select("o_custkey", "o_orderpriority").distinct()
    rows = orders.join(t("customer"), F.expr("c_custkey = o_custkey")).join(t("nation"), F.expr("n_nationkey = c_nationkey"))
    return rows.select("n_name", "o_orderpriority").distinct()


@query("h4_one_per_key", """
SELECT o_custkey, CAST(tahun AS INTEGER) AS tahun, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, year(o_orderdate) AS tahun, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def one_per_key(t: Source) -> DataFrame:
    rows = t("orders").selectExpr("o_custkey", "year(o_orderdate) AS tahun", "o_orderkey", "o_totalprice", "o_orderdate")
    first = reshape.one_per_key(rows, ["o_custkey", "tahun"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return first.drop("o_orderdate")


@query("h5_intersect", """
SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 0
INTERSECT SELECT n_name FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_custkey % 7 = 0""")
def intersect(t: Source) -> DataFrame:
    nation = t("nation")
    left = t("supplier").where("s_suppkey % 3 = 0").join(nation, F.expr("n_nationkey = s_nationkey")).select("n_name")
    right = t("customer").where("c_custkey % 7 = 0").join(nation, F.expr("n_nationkey = c_nationkey")).select("n_name")
    return left.intersect(right)


@query("h6_commodity_rows", on_lines("""
SELECT id_asal AS id_wilayah, tahun, k AS id_komoditas,
  CASE WHEN (k = 1 AND id_asal % 4 <> 0) OR (k = 2 AND id_asal % 5 <> 0) THEN q ELSE q2 END AS populasi, c AS jumlah_ternak_potong FROM (
    SELECT id_asal, tahun, CASE p_type WHEN 'SMALL' THEN 1 ELSE 2 END AS k, sum(l_quantity) AS q, sum(l_linenumber) * 1e0 AS q2, count(*) * 1e0 AS c
    FROM lines WHERE p_type IN ('SMALL', 'LARGE') GROUP BY ALL)"""))
def commodity_rows(t: Source) -> DataFrame:
    def part(kind: str, value: str) -> F.Column:
        return F.expr(f"sum(if(p_type = '{kind}', {value}, NULL))")

    wide = standin.lines(t).groupBy(F.col("id_asal").alias("id_wilayah"), "tahun").agg(
        part("SMALL", "l_quantity").alias("s"), part("LARGE", "l_quantity").alias("l"),
        part("SMALL", "l_linenumber").alias("populasi_sapi_dummy"), part("LARGE", "l_linenumber").alias("populasi_ayam_dummy"),
        part("SMALL", "1").alias("jumlah_ternak_sapi_potong"), part("LARGE", "1").alias("jumlah_ternak_ayam_potong"),
    ).withColumns({"populasi_sapi": F.expr("if(id_wilayah % 4 <> 0, s, NULL)"), "populasi_ayam": F.expr("if(id_wilayah % 5 <> 0, l, NULL)")})
    unused = [
        f"{m}_{k}" for k in ("sapi", "ayam") for m in ("produksi_daging", "konsumsi_daging", "permintaan_daging", "harga_baseline")
    ] + ["produksi_daging_ayam_dummy"]
    wide = wide.withColumns({c: F.lit(None).cast("double") for c in unused})
    out = reshape.commodity_rows(wide).select("id_wilayah", "tahun", "id_komoditas", "populasi", "jumlah_ternak_potong")
    return out.where("jumlah_ternak_potong IS NOT NULL")


def long_sql(value: str, digits: int, where: str = "TRUE") -> str:
    return on_cube(f"""
SELECT nama_provinsi, tahun || '/' || lpad(CAST(bulan AS VARCHAR), 2, '0') AS periode, {r(f"avg({value})", digits)} AS nilai
FROM cube WHERE {value} IS NOT NULL AND {where} GROUP BY ALL""")


def long_heatmap(rows: DataFrame, months: list[str], value: str, digits: int) -> DataFrame:
    """The filled cells of a heatmap over all months of the data, a row each."""
    period = dates.period_slash(F.col("tahun"), F.col("bulan"))
    wide = reshape.heatmap(rows, "nama_provinsi", period, value, months)
    cells = reshape.longer(wide, ["nama_provinsi"], months, "periode", "nilai")
    return tidy(cells.where("nilai IS NOT NULL"), {"nilai": digits})


@query("h7_risk_heatmap", long_sql("supply_risk_index", 6))
def risk_heatmap(t: Source) -> DataFrame:
    cube = standin.cube(t, staged=True)
    return long_heatmap(cube, result_sets.month_labels(cube), "supply_risk_index", 6)


@query("h8_price_heatmap", long_sql("avg_harga", 4, "nama_komoditas = 'SMALL'"))
def price_heatmap(t: Source) -> DataFrame:
    cube = standin.cube(t, staged=True)
    rows = cube.where("nama_komoditas = 'SMALL' AND avg_harga IS NOT NULL")
    return long_heatmap(rows, result_sets.month_labels(cube), "avg_harga", 4)


@query("h9_longer", f"""WITH {CUBE}, {GAPS}
SELECT nama_komoditas, 'ekor_surplus' AS status, count(*) FILTER (gap_ekor > 0) AS n FROM gaps GROUP BY 1
UNION ALL SELECT nama_komoditas, 'kg_surplus', count(*) FILTER (gap_kg > 0) FROM gaps GROUP BY 1""")
def longer(t: Source) -> DataFrame:
    counts = rollups.monthly_gap(standin.cube(t)).groupBy("nama_komoditas").agg(
        F.expr("count_if(gap_ekor > 0) AS ekor_surplus"), F.expr("count_if(gap_kg > 0) AS kg_surplus")
    )
    return reshape.longer(counts, ["nama_komoditas"], ["ekor_surplus", "kg_surplus"], "status", "n")
