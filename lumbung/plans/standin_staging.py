"""Raw staging tables derived from the order-processing schema, as the sources would deliver them.

Parts of type SMALL are cattle, LARGE ones chickens, all others an animal without a code. Order
lines are movements, returned ones sick reports, first lines of an order slaughters, and each has
a price. Numbers and dates are text, regions are numbered differently by the event tables, and
some values are missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions.numeric import stable_round
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.session import stage
from lumbung.sources.literals import literal_table

ANIMAL = "CASE p_type WHEN 'SMALL' THEN 'H1' WHEN 'LARGE' THEN 'H2' ELSE 'H3' END"
DAY = "date_format(o_orderdate, 'M/d/yyyy')"


def _lines(t: Source) -> DataFrame:
    """The order lines with all that the staging tables need of them.

    Stored, as six staging tables come from them: the lines are joined and shuffled once.
    """
    orders = t("orders").selectExpr("o_orderkey AS l_orderkey", "o_orderdate")
    return stage(standin.lines(t, month=False).join(orders, "l_orderkey").selectExpr(
        "id_asal", "p_type", "p_retailprice", "o_orderdate", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_orderkey % 20 <> 0 AS priced",
    ), "order-lines").withColumns({"wilayah": F.expr("100 - id_asal"), "tgl": F.expr(DAY), "hewan": F.expr(ANIMAL)})


def _annual(t: Source, lines: DataFrame) -> DataFrame:
    """Quantity, lines and mean retail price of cattle (1) and chickens (2), per region and year."""
    parts = [
        F.expr(f"{how} FILTER (WHERE p_type = '{kind}')").alias(f"{name}{i}")
        for i, kind in ((1, "SMALL"), (2, "LARGE"))
        for name, how in (("q", "sum(l_quantity)"), ("c", "count(*)"), ("r", "avg(p_retailprice)"))
    ]
    return lines.groupBy("id_asal", F.year("o_orderdate").alias("tahun")).agg(*parts).join(
        t("nation").selectExpr("n_nationkey AS id_asal", "n_name AS provinsi"), "id_asal"
    ).withColumns({"r1": stable_round("r1", 2), "r2": stable_round("r2", 2)})


def local_text(number: str) -> str:
    """A whole number with points between thousands."""
    return f"translate(format_number({number}, 0), ',', '.')"


def staging(t: Source) -> dict[str, DataFrame]:
    """The staging tables by name, as ``warehouse.build_warehouse`` takes them."""
    lines = _lines(t)
    annual = _annual(t, lines)
    api = annual.selectExpr(
        "provinsi", "string(tahun) AS tahun", f"{local_text('1000 * (id_asal + 1)')} AS jumlah_penduduk",
        f"if((id_asal + tahun) % 5 <> 0, {local_text('q1')}, NULL) AS populasi_sapi", f"{local_text('q2')} AS populasi_ayam",
        f"if((id_asal + tahun) % 7 <> 0, {local_text('c2')}, '-') AS produksi_daging_ayam",
    )
    substitute = annual.selectExpr(
        "provinsi", "tahun", "q1 + 1 AS populasi_sapi_dummy", "q2 + 1 AS populasi_ayam_dummy",
        "nullif(double(c1), 0D) AS produksi_daging_sapi_dummy", "nullif(double(c2), 0D) AS produksi_daging_ayam_dummy",
        "2D AS konsumsi_daging_sapi_dummy", "9D AS konsumsi_daging_ayam_dummy", "q1 / 2 AS permintaan_daging_sapi_dummy",
        "q2 / 2 AS permintaan_daging_ayam_dummy", "double(c1) AS jumlah_ternak_sapi_potong_dummy",
        "double(c2) AS jumlah_ternak_ayam_potong_dummy", "r1 AS harga_baseline_sapi_dummy", "r2 AS harga_baseline_ayam_dummy",
        "0.01D AS growth_populasi_dummy",
    )
    price = "if(priced, string(l_extendedprice / l_quantity), NULL)"
    return {
        "bps_api_raw": api,
        "bps_dummy_raw": substitute,
        "ref_hewan": literal_table(
            t.spark, ["id_hewan", "nama_hewan", "kategori"], [("H1", "Sapi", "besar"), ("H2", "AYAM", "unggas"), ("H3", "Kambing", "kecil")]
        ),
        "ref_wilayah": t("nation").selectExpr("100 - n_nationkey AS id_wilayah", "n_name AS provinsi"),
        "tr_mutasi": lines.selectExpr("tgl AS tgl_mutasi", "wilayah AS id_asal", "0 AS id_tujuan", "hewan AS id_hewan", "l_quantity AS jumlah_ekor"),
        "tr_laporan_sakit": lines.where("l_returnflag = 'R'").selectExpr(
            "tgl AS tgl_lapor", "wilayah AS id_wilayah", "hewan AS id_hewan", "l_quantity AS jumlah_gejala",
            "if(l_linestatus = 'F', l_quantity, NULL) AS jumlah_mati",
        ),
        "tr_rph": lines.where("l_linenumber = 1").selectExpr(
            "tgl AS tgl_potong", "wilayah AS id_wilayah", "hewan AS id_hewan", "l_extendedprice AS berat_karkas"
        ),
        "pihps_raw": lines.where("hewan <> 'H3'").join(t("nation").selectExpr("n_nationkey AS id_asal", "n_name AS provinsi"), "id_asal").selectExpr(
            "provinsi", "if(hewan = 'H1', 'Daging Sapi Murni', 'daging ayam ras') AS nama_komoditas", f"{price} AS harga", "string(o_orderdate) AS waktu"
        ),
    }
