"""The supply-risk tables derived from an order-processing schema.

nation = region, p_type = commodity, order month = month. A line is a movement from the
supplier's nation to the customer's nation; returned lines are sick animals, returned and finished
ones dead; revenue is carcass weight; price per unit is the price, the part's retail price its
baseline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions.numeric import stable_round
from lumbung.operators import dimensions, imputation
from lumbung.plans.warehouse import ANNUAL_MEASURES, Tables, cube_of, integrate, risk_fact
from lumbung.session import stage
from lumbung.sources import sinks
from lumbung.sources.readers import read_staging


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Source:
    """The Parquet tables of one folder, read with their known schemas."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def __call__(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = read_staging(self.spark, self.folder, table, SCHEMAS.get(table))
        return self._tables[table]


# A fixed list of commodities, as the literal-table query wants one; all others use ``commodities``.
COMMODITIES = ((1, "ECONOMY"), (2, "LARGE"), (3, "MEDIUM"), (4, "PROMO"), (5, "SMALL"), (6, "STANDARD"))

REVENUE = "l_extendedprice * (1 - l_discount)"
UNIT_PRICE = "l_extendedprice / l_quantity"
RETURNED = "CASE WHEN l_returnflag = 'R' THEN l_quantity END"
RETURNED_FINISHED = "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity END"


def commodities(t: Source) -> DataFrame:
    """dim_komoditas: the types that the parts have, keyed in name order."""
    return dimensions.commodity_dimension_of(t("part").where("p_type IS NOT NULL"), "p_type")


def lines(t: Source, *, month: bool = True, commodity: bool = True, origin: bool = True, destination: bool = False) -> DataFrame:
    """Order lines with only the attributes a query needs.

    The smaller tables come first, so that where they are broadcast the lines are shuffled once,
    for the orders.
    """
    df = t("lineitem")
    if origin:
        df = df.join(t("supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey AS id_asal"), "l_suppkey")
    if commodity:
        # The types are few: a sorted array of them, read once, codes the parts without a join.
        kinds = t("part").agg(F.array_sort(F.collect_set("p_type")).alias("kinds")).scalar()
        code = F.coalesce(F.array_position(kinds, F.col("p_type")).cast("int"), F.lit(0))
        part = t("part").selectExpr("p_partkey AS l_partkey", "p_type", "p_retailprice").withColumn("id_komoditas", code)
        df = df.join(part, "l_partkey")
    if month or destination:
        orders = t("orders").selectExpr(
            "o_orderkey AS l_orderkey", "o_custkey", "year(o_orderdate) AS tahun", "month(o_orderdate) AS bulan"
        )
        if destination:
            customer = t("customer").selectExpr("c_custkey AS o_custkey", "c_nationkey AS id_tujuan")
            orders = orders.join(customer, "o_custkey")
        df = df.join(orders.drop("o_custkey"), "l_orderkey")
    return df


def flow(t: Source) -> DataFrame:
    """The one pass over the order lines: sums per origin and month, and per destination and year.

    Both groupings come from the same rows, so the lines are joined and shuffled once. Each task
    sends at most one row per group of either kind, and everything after this works on a table
    whose size depends on regions, months and commodities and not on the number of lines. Rows of
    the first kind have an origin, those of the second a destination.
    """
    sums = {
        "qty": "l_quantity", "qty_sakit": RETURNED, "qty_mati": RETURNED_FINISHED, "karkas": REVENUE,
        "harga": UNIT_PRICE, "dasar": "p_retailprice",
    }
    keys = ["id_asal", "id_tujuan", "tahun", "bulan", "id_komoditas"]
    groups = [["id_asal", "tahun", "bulan", "id_komoditas"], ["id_tujuan", "tahun", "id_komoditas"]]
    return lines(t, destination=True).groupingSets(groups, *keys).agg(
        F.expr("count(*) AS n"), *[F.expr(f"sum({e}) AS {name}") for name, e in sums.items()]
    )


def region_dim(t: Source) -> DataFrame:
    """dim_prov with the nation's own id as its source id."""
    return dimensions.numbered(
        t("nation").selectExpr("n_nationkey AS id_prov", "n_name AS nama_provinsi"), ["nama_provinsi"], "prov_key"
    ).select("prov_key", "id_prov", "nama_provinsi")


def time_dim(df: DataFrame, year: str = "tahun") -> DataFrame:
    return dimensions.time_dimension(dimensions.month_spine(dimensions.year_bounds(df, year)))


def dims_of(t: Source, flows: DataFrame | None = None) -> Tables:
    """The three dimensions; the months span the years of the flow, or else of the orders."""
    years = t("orders").selectExpr("year(o_orderdate) AS tahun") if flows is None else flows
    return {
        "dim_prov": region_dim(t),
        "dim_komoditas": commodities(t),
        "dim_waktu": time_dim(years),
    }


def monthly(flows: DataFrame, hide: bool = True) -> DataFrame:
    """Monthly measures by origin. One price in twenty is hidden to give imputation work."""
    price = "harga / n"
    if hide:
        price = f"CASE WHEN pmod(id_asal * 7 + tahun * 12 + bulan, 20) <> 0 THEN {price} END"
    return flows.where("id_asal IS NOT NULL").select(
        F.expr("id_asal AS id_wilayah"), "tahun", "bulan", "id_komoditas", F.expr("qty_sakit AS sum_jumlah_sakit"),
        F.expr("qty_mati AS sum_jumlah_mati"), F.expr("qty AS sum_vol_mutasi"),
        stable_round("karkas", 2).alias("sum_realisasi_karkas"), F.expr(f"{price} AS avg_harga"),
    )


def demography(t: Source) -> DataFrame:
    """Inhabitants and growth per region."""
    return t("customer").groupBy(F.expr("c_nationkey AS id_wilayah")).agg(
        F.expr("count(*) AS jumlah_penduduk"), stable_round("avg(c_acctbal) / 10000", 6).alias("growth_populasi")
    )


def annual(flows: DataFrame, hide: bool = True) -> DataFrame:
    """Statistics per region, year and commodity: supply by origin, demand by destination.

    Some values are hidden for imputation.
    """
    herd, demand = "sum(q)", "sum(w)"
    if hide:
        herd = f"CASE WHEN pmod(id_wilayah * 3 + tahun + id_komoditas, 20) <> 0 THEN {herd} END"
        demand = f"CASE WHEN pmod(id_wilayah * 3 + tahun + id_komoditas, 20) <> 7 THEN {demand} END"
    sides = flows.selectExpr(
        "coalesce(id_asal, id_tujuan) AS id_wilayah", "tahun", "id_komoditas", "if(id_asal IS NOT NULL, qty, NULL) AS q",
        "if(id_asal IS NOT NULL, karkas, NULL) AS k", "if(id_asal IS NOT NULL, n, NULL) AS c",
        "if(id_asal IS NOT NULL, dasar, NULL) AS d", "if(id_asal IS NULL, qty, NULL) AS w", "if(id_asal IS NULL, n, NULL) AS m",
    )
    return sides.groupBy("id_wilayah", "tahun", "id_komoditas").agg(
        F.expr(f"{herd} AS populasi"), stable_round("sum(k) / 1000", 3).alias("produksi_daging"),
        F.expr("try_divide(sum(w), sum(m)) AS konsumsi_daging"), F.expr(f"{demand} AS permintaan_daging"),
        F.expr("CAST(sum(c) AS double) AS jumlah_ternak_potong"), F.expr("try_divide(sum(d), sum(c)) AS harga_baseline"),
    )


def integrated(t: Source, flows: DataFrame) -> DataFrame:
    """Staged monthly rows with their annual statistics."""
    stats = imputation.fill_with_mean(annual(flows), ["id_wilayah", "id_komoditas"], ANNUAL_MEASURES)
    return stage(integrate(monthly(flows), stats, demography(t), ["id_wilayah"]), "integrated")


def staged_flow(t: Source) -> DataFrame:
    return stage(flow(t), "flow")


def staged_integrated(t: Source) -> DataFrame:
    return integrated(t, staged_flow(t))


def warehouse(t: Source) -> Tables:
    """Dimensions and fact table."""
    flows = staged_flow(t)
    dims = dims_of(t, flows)
    return {**dims, sinks.FACT: risk_fact(integrated(t, flows), dims)}


def cube(t: Source, staged: bool = False) -> DataFrame:
    """The cube; stage it for a query that reads it more than once."""
    rows = cube_of(warehouse(t))
    return stage(rows, "cube") if staged else rows
