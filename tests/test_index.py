"""The index against known results."""

import pytest
from pyspark.sql import functions as F

from lumbung.operators import index

COLUMNS = (
    "prov_key int, waktu_key int, komoditas_key int, avg_harga double, harga_baseline double, sum_jumlah_sakit double, "
    "sum_jumlah_mati double, populasi_ternak double, sum_vol_mutasi double, avg_permintaan_bulanan double, expected double"
)
# Known rows of the warehouse. They include the rows with the least and the greatest
# value of each component over the whole table, so that scaling these rows scales as the table does.
KNOWN = [
    (5, 68, 2, 20588.02, 39567.0, 0.0, 0.0, 57349790.0, 0.0, 8485.87, 0.0),
    (9, 72, 2, 45117.39, 21507.0, 0.0, 0.0, 765738937.0, 0.0, 25973.26, 0.333333),
    (1, 49, 2, 20567.77, 28021.0, 0.0, 0.0, 36541907.0, 0.0, 46353.04, 0.045152),
    (6, 57, 1, 162569.05, 109127.0, 46.0, 20.0, 2684.0, 0.0, 8948.38, 0.538174),
    (28, 49, 1, 105352.02, 95681.0, 0.0, 0.0, 21529.0, 296.0, 388.14, 0.45605),
    (6, 62, 1, 147783.33, 94575.0, 41.0, 14.0, 2764.0, 0.0, 9829.37, 0.489979),
    (6, 65, 1, 150772.73, 94575.0, 22.0, 17.0, 2764.0, 0.0, 9829.37, 0.418189),
    (1, 54, 2, 21576.92, 28021.0, 0.0, 0.0, 36541907.0, 0.0, 46353.04, 0.052763),
    (12, 50, 2, 20723.87, 23396.0, 0.0, 0.0, 58018198.0, 63.0, 18890.82, 0.078681),
    (22, 70, 2, 32096.03, 21745.0, 0.0, 0.0, 16214419.0, 0.0, 56616.65, 0.201945),
    (36, 54, 2, 20809.39, 20951.0, 46.0, 1.0, 112189664.0, 0.0, 7162.97, 0.099935),
    (10, 50, 1, 140091.27, 92583.0, 39.0, 16.0, 1284673.0, 0.0, 6690.21, 0.21037),
    (20, 70, 1, 105115.49, 117413.0, 0.0, 0.0, 46590.0, 0.0, 2320.44, 0.079226),
    (34, 51, 1, 105220.28, 107800.0, 0.0, 0.0, 60345.0, 0.0, 6515.93, 0.096301),
]


def test_known_rows(spark):
    df = spark.createDataFrame(KNOWN, COLUMNS)
    for row in index.with_index(index.with_components(df)).collect():
        assert row.supply_risk_index == pytest.approx(row.expected, abs=1.5e-6), (row.prov_key, row.waktu_key)


@pytest.mark.parametrize(
    ("values", "expected"),
    [([3.0, 3.0], [0.0, 0.0]), ([0.0, 0.0], [0.0, 0.0]), ([1.0, 3.0, 2.0], [0.0, 1.0, 0.5]), ([-1.0, 0.0], [0.0, 0.5]), ([None, 2.0, 4.0], [None, 0.0, 1.0])],
)
def test_min_max_edges(spark, values, expected):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = index.min_max_scaled(df, {"v": "s"}).orderBy("i").collect()
    assert [r.s for r in got] == expected


def test_index_stays_in_range(spark):
    df = spark.range(500).select(
        (F.rand(1) * 100).alias("avg_harga"), (F.rand(2) * 100 - 10).alias("harga_baseline"),
        (F.rand(3) * 9).alias("sum_jumlah_sakit"), (F.rand(4) * 9).alias("sum_jumlah_mati"),
        F.when(F.rand(5) > 0.1, F.rand(6) * 1000).alias("populasi_ternak"), (F.rand(7) * 50).alias("sum_vol_mutasi"),
        F.when(F.rand(8) > 0.1, F.rand(9) * 20).alias("avg_permintaan_bulanan"),
    )
    row = index.with_index(index.with_components(df)).agg(
        F.min("supply_risk_index").alias("lo"), F.max("supply_risk_index").alias("hi"), F.count("supply_risk_index").alias("n")
    ).first()
    assert row.lo >= 0 and row.hi <= 1 and row.n == 500
