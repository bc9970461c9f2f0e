"""Operators on tables where one key holds more than a third of all rows, against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumbung.operators import cleaning, imputation, measures, quality, reshape, rollups
from lumbung.sources import indicators


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(5)
    n = 40_000
    pdf = pd.DataFrame({
        "id": np.arange(n),
        "id_wilayah": np.where(rng.random(n) < 0.4, 7, rng.integers(0, 30, n)),
        "id_hewan": np.where(rng.random(n) < 0.5, "H1", rng.choice(["H2", "H3", "H9"], n)),
        "tgl_bulan": rng.integers(1, 13, n), "tgl_tahun": rng.integers(2023, 2025, n),
        "v": rng.integers(0, 50, n).astype(float),
    })
    pdf.loc[rng.random(n) < 0.1, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return pdf, df.repartition(8).cache()


def test_monthly_sums(spark, events):
    pdf, df = events
    animals = spark.createDataFrame([("H1", 1), ("H2", 2), ("H3", 1)], "id_hewan string, id_komoditas int")
    got = measures.monthly_sums(df, "id_wilayah", "tgl", {"total": "v"}, animals).toPandas()
    pdf = pdf.assign(id_komoditas=pdf.id_hewan.map({"H1": 1, "H2": 2, "H3": 1}).fillna(0).astype(int))
    want = pdf.groupby(["id_wilayah", "tgl_bulan", "tgl_tahun", "id_komoditas"]).v.sum(min_count=1)
    merged = got.set_index(["id_wilayah", "bulan", "tahun", "id_komoditas"]).total
    assert len(merged) == len(want)
    pd.testing.assert_series_equal(merged.sort_index(), want.sort_index(), check_names=False, check_index_type=False, check_dtype=False)


def test_orphans(spark, events):
    pdf, df = events
    keys = spark.createDataFrame([(k,) for k in range(30) if k not in (7, 8)], "k long")
    nulled = df.withColumn("id_wilayah", F.expr("if(id % 100 = 0, NULL, id_wilayah)"))
    lost = pdf[pdf.id % 100 != 0].id_wilayah.isin([7, 8])
    assert quality.orphan_keys("e", nulled, "id_wilayah", keys, "k").first().bad_rows == 2
    assert quality.orphan_rows("e", nulled, "id_wilayah", keys, "k").first().bad_rows == lost.sum() + (pdf.id % 100 == 0).sum()


def test_first_and_latest(events):
    pdf, df = events
    best = indicators.first_valid(df.where("v IS NOT NULL"), ["id_wilayah"], [-F.col("v"), F.col("id")], ["id", "v"]).toPandas()
    want = pdf.dropna().sort_values(["v", "id"], ascending=[False, True]).groupby("id_wilayah").id.first()
    assert dict(zip(best.id_wilayah, best.id)) == want.to_dict()
    one = reshape.one_per_key(df, ["id_wilayah", "tgl_tahun"], [F.col("id")]).toPandas()
    assert dict(zip(zip(one.id_wilayah, one.tgl_tahun), one.id)) == pdf.groupby(["id_wilayah", "tgl_tahun"]).id.min().to_dict()
    latest = rollups.latest_rows(df, "id_wilayah", "tgl_bulan").count()
    assert latest == (pdf.tgl_bulan == pdf.groupby("id_wilayah").tgl_bulan.transform("max")).sum()


def test_median_fill(events):
    pdf, df = events
    got = imputation.fill_with_median(df, ["id_wilayah"], "v").agg(F.sum("v"), F.count("v")).first()
    filled = pdf.v.fillna(pdf.groupby("id_wilayah").v.transform(lambda s: s.dropna().sort_values().iloc[(s.notna().sum() + 1) // 2 - 1]))
    assert tuple(got) == (pytest.approx(filled.sum()), len(pdf))


def test_duplicates_and_conversion(events):
    pdf, df = events
    kept = cleaning.drop_empty_and_repeated(df.select("id_wilayah", "id_hewan", "v"), ["v"])
    assert kept.count() == len(pdf[["id_wilayah", "id_hewan", "v"]].dropna(subset=["v"]).drop_duplicates())
    bad = quality.wrong_types("e", df.select(F.expr("if(id % 50 = 0, 'x', string(v)) AS v")), {"v": "double"}).first().bad_rows
    assert bad == (pdf.id % 50 == 0).sum()
