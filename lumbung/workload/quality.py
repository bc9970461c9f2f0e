"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.operators import quality
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.session import stage
from lumbung.sources import sinks
from lumbung.workload.base import FACT, query
from lumbung.workload.sources import TABLES, counts_sql


def row_sql(check: str, table: str, column: str, bad: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, "
        f"CAST({bad} AS BIGINT) AS bad_rows FROM {source}"
    )


@query("l1_required_columns", " UNION ALL ".join([
    row_sql("required_column", "orders", "o_orderkey", "0", "(SELECT count(*) FROM orders)"),
    row_sql("required_column", "orders", "o_comment", "count(*)", "orders"),
    row_sql("required_column", "lineitem", "l_partkey", "0", "(SELECT count(*) FROM lineitem)"),
]))
def required_columns(t: Source) -> DataFrame:
    orders = quality.required_columns("orders", t("orders"), ["o_orderkey", "o_comment"])
    return orders.unionByName(quality.required_columns("lineitem", t("lineitem"), ["l_partkey"]))


@query("l2_null_keys", " UNION ALL ".join([
    row_sql("null_key", "lineitem", c, f"count(*) FILTER (l_orderkey % {d} = 0)", "lineitem")
    for c, d in (("l_partkey", 20), ("l_suppkey", 30))
]))
def null_keys(t: Source) -> DataFrame:
    rows = t("lineitem").selectExpr(
        "if(l_orderkey % 20 = 0, NULL, l_partkey) AS l_partkey", "if(l_orderkey % 30 = 0, NULL, l_suppkey) AS l_suppkey"
    )
    return quality.null_counts("lineitem", rows, check="null_key")


@query("l3_referential_integrity", " UNION ALL ".join([
    row_sql("orphan_key", "lineitem", "l_partkey", "count(DISTINCT l_partkey)", "lineitem WHERE l_partkey % 40 = 0"),
    row_sql("orphan_row", "lineitem", "l_suppkey", "count(*)", "lineitem WHERE l_suppkey % 10 = 0"),
]))
def referential_integrity(t: Source) -> DataFrame:
    line = t("lineitem")
    parts = quality.orphan_keys("lineitem", line, "l_partkey", t("part").where("p_partkey % 40 <> 0"), "p_partkey")
    suppliers = quality.orphan_rows("lineitem", line, "l_suppkey", t("supplier").where("s_suppkey % 10 <> 0"), "s_suppkey")
    return parts.unionByName(suppliers)


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("l4_null_counts", " UNION ALL ".join(
    row_sql("null", "orders", c, "count(*) FILTER (o_orderkey % 20 = 0)" if c == "o_totalprice" else "0",
            "orders" if c == "o_totalprice" else "(SELECT count(*) FROM orders)")
    for c in ORDER_COLUMNS
))
def null_counts(t: Source) -> DataFrame:
    return quality.null_counts("orders", t("orders").withColumn("o_totalprice", F.expr("if(o_orderkey % 20 = 0, NULL, o_totalprice)")))


STAR_KEYS = ("prov_key", "waktu_key", "komoditas_key")
REQUIRED = (("dim_prov", "prov_key"), ("dim_prov", "nama_provinsi"), ("dim_komoditas", "komoditas_key"),
            ("dim_komoditas", "nama_komoditas"), ("dim_waktu", "waktu_key"), ("dim_waktu", "tahun"), ("dim_waktu", "bulan"),
            *((sinks.FACT, c) for c in (*STAR_KEYS, "supply_risk_index")))


@query("l5_gate_report", f"WITH {FACT} " + " UNION ALL ".join(
    [row_sql("required_column", table, c, "0", "(SELECT 1)") for table, c in REQUIRED]
    + [row_sql("null_key", sinks.FACT, "prov_key", "count(*) FILTER (waktu_key % 20 = 0)", "fact")]
    + [row_sql("null_key", sinks.FACT, c, f"count(*) FILTER ({c} IS NULL)", "fact") for c in STAR_KEYS[1:]]
    + [row_sql("orphan_key", sinks.FACT, "prov_key", "0", "(SELECT 1)"),
       row_sql("orphan_key", sinks.FACT, "waktu_key", "count(DISTINCT waktu_key)", "fact WHERE waktu_key % 15 = 0"),
       row_sql("orphan_key", sinks.FACT, "komoditas_key", "0", "(SELECT 1)"),
       row_sql("unique", sinks.FACT, ",".join(STAR_KEYS), "count(*)",
               "(SELECT 1 FROM fact WHERE waktu_key % 20 = 0 GROUP BY waktu_key, komoditas_key HAVING count(*) > 1)")]
))
def gate_report(t: Source) -> DataFrame:
    w = standin.warehouse(t)
    fact = stage(w[sinks.FACT], "fact").withColumn("prov_key", F.expr("if(waktu_key % 20 = 0, NULL, prov_key)"))
    return quality.warehouse_report(fact, w["dim_prov"], w["dim_komoditas"], w["dim_waktu"].where("waktu_key % 15 <> 0"))


@query("l6_table_counts", counts_sql(TABLES))
def table_counts(t: Source) -> DataFrame:
    for name in TABLES:
        t(name).createOrReplaceTempView(name)
    present = {table.name for table in t.spark.catalog.listTables()}
    return sinks.row_counts({name: t.spark.table(name) for name in TABLES if name in present})


@query("l7_uniqueness", " UNION ALL ".join([
    row_sql("unique", "orders", "o_orderkey", "count(*)", "(SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)"),
    row_sql("unique", "lineitem", "l_orderkey,l_partkey", "count(*)",
            "(SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)"),
    row_sql("unique", "orders", "o_custkey,o_orderdate", "count(*)",
            "(SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)"),
]))
def uniqueness(t: Source) -> DataFrame:
    return (
        quality.repeated_keys("orders", t("orders"), ["o_orderkey"])
        .unionByName(quality.repeated_keys("lineitem", t("lineitem"), ["l_orderkey", "l_partkey"]))
        .unionByName(quality.repeated_keys("orders", t("orders"), ["o_custkey", "o_orderdate"]))
    )


@query("l8_type_conformance", " UNION ALL ".join([
    row_sql("type", "lineitem", "l_quantity", "count(*) FILTER (l_orderkey % 20 = 0)", "lineitem"),
    row_sql("type", "lineitem", "l_linenumber", "count(*) FILTER (l_orderkey % 30 = 0)", "lineitem"),
    row_sql("type", "lineitem", "l_returnflag", "0", "(SELECT count(*) FROM lineitem)"),
]))
def type_conformance(t: Source) -> DataFrame:
    raw = t("lineitem").selectExpr(
        "if(l_orderkey % 20 = 0, 'many', string(l_quantity)) AS l_quantity",
        "if(l_orderkey % 30 = 0, NULL, string(l_linenumber)) AS l_linenumber", "l_returnflag",
    )
    types = {"l_quantity": "double", "l_linenumber": "smallint", "l_returnflag": "string"}
    return quality.wrong_types("lineitem", raw, types, required=["l_linenumber"])
