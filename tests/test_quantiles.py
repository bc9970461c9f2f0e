"""Exact quantiles against sorting."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumbung.operators import imputation, quantiles


def brute(values, p, method):
    v = sorted(values)
    if method == "disc":
        return v[max(1, math.ceil(len(v) * p)) - 1]
    return float(np.quantile(v, p))


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    rows = [("hot", rng.lognormvariate(3, 2)) for _ in range(60_000)]
    rows += [("steps", float(rng.randint(0, 40))) for _ in range(25_000)]
    rows += [("constant", 4.0)] * 15_000
    rows += [("small", float(i)) for i in range(7)] + [("one", 3.5), ("two", 1.0), ("two", 2.0)]
    rows += [("hot", None), ("empty", None)]
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v"))).repartition(6).cache()


@pytest.mark.parametrize("method", ["disc", "cont"])
@pytest.mark.parametrize("small", [True, False])
def test_against_sorting(frame, method, small):
    pdf, df = frame
    wanted = {"q2": 0.5, "q0": 0.0, "q1": 0.25, "q3": 0.75, "q9": 0.999, "q5": 0.5005, "q4": 1.0}
    if small:
        out = quantiles.grouped_quantiles(df, ["k"], "v", wanted, method)
    else:
        out = quantiles.exact_quantiles(df, ["k"], F.col("v"), wanted, method)
    got = {r.k: r for r in out.collect()}
    assert set(got) == {"hot", "steps", "constant", "small", "one", "two"}
    for k, group in pdf.dropna().groupby("k"):
        for name, p in wanted.items():
            assert got[k][name] == pytest.approx(brute(group.v, p, method), rel=1e-12), (k, name)


def test_without_groups(frame):
    pdf, df = frame
    got = quantiles.exact_median(df, [], F.col("v"), "m").first().m
    assert got == brute(pdf.v.dropna(), 0.5, "disc")


def test_few_rows_of_a_hot_group_are_ranked(frame, monkeypatch):
    """Values outside the brackets are only counted, those inside are a small part of the group."""
    _, df = frame
    staged = {}
    real = quantiles.stage
    monkeypatch.setattr(quantiles, "stage", lambda d, name: staged.setdefault(name, real(d, name)))
    quantiles.exact_median(df, ["k"], F.col("v"), "m").collect()
    counts = staged["quantile-counts"].where("k = 'hot'")
    assert counts.agg(F.sum("_c")).first()[0] == 60_000
    assert counts.count() < 0.01 * 60_000
    largest = counts.groupBy("_place", "_cell").count().agg(F.max("count")).first()[0]
    assert largest < 30


def test_values_of_either_sign_and_null_keys(spark):
    rng = random.Random(3)
    rows = [(None if i % 3 else "a", rng.gauss(0, 5)) for i in range(30_000)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.lo, r.m) for r in quantiles.exact_quantiles(df, ["k"], F.col("v"), {"m": 0.5, "lo": 0.01}).collect()}
    for k in (None, "a"):
        group = [v for key, v in rows if key == k]
        assert got[k] == (brute(group, 0.01, "disc"), brute(group, 0.5, "disc"))


def test_five_numbers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 5, 100)] + [("a", None)], "k string, v double")
    for detail in (False, True):
        row = quantiles.five_numbers(df, ["k"], "v", detail).first()
        assert (row.q0, row.q1, row.q2, row.q3, row.q4) == (1.0, 2.25, 3.5, 4.75, 100.0)
        assert (row.n, row.n_outliers, row.lower_whisker, row.upper_whisker) == (6, 1, 1.0, 5.0)


def test_median_fill_changes_only_nulls(frame):
    pdf, df = frame
    filled = imputation.fill_with_median(df, ["k"], "v")
    assert filled.count() == len(pdf)
    assert filled.where("k = 'empty' AND v IS NULL").count() == 1
    assert filled.where("v IS NULL").count() == 1
    total = filled.where("k = 'hot'").agg(F.sum("v")).first()[0]
    hot = pdf[pdf.k == "hot"].v.dropna()
    assert total == pytest.approx(hot.sum() + brute(hot, 0.5, "disc"))


def test_price_cascade(spark):
    rows = [
        (1, 1, 2024, 1, None), (1, 1, 2024, 2, 10.0), (1, 1, 2024, 3, None), (1, 1, 2024, 5, None), (1, 1, 2024, 6, 30.0),
        (2, 1, 2024, 1, None), (2, 2, 2024, 1, 7.0),
    ]
    df = spark.createDataFrame(rows, "id_wilayah int, id_komoditas int, tahun int, bulan int, avg_harga double")
    got = {(r.id_wilayah, r.id_komoditas, r.bulan): r.avg_harga for r in imputation.fill_price_gaps(df).collect()}
    assert got == {(1, 1, 1): 10.0, (1, 1, 2): 10.0, (1, 1, 3): 10.0, (1, 1, 5): 10.0, (1, 1, 6): 30.0, (2, 1, 1): 10.0, (2, 2, 1): 7.0}


def test_mean_fill(spark):
    df = spark.createDataFrame([(1, 2020, 4.0), (1, 2021, None), (1, 2022, 8.0), (2, 2020, None)], "k int, tahun int, v double")
    got = {(r.k, r.tahun): r.v for r in imputation.fill_with_mean(df, ["k"], ["v"]).collect()}
    assert got == {(1, 2020): 4.0, (1, 2021): 6.0, (1, 2022): 8.0, (2, 2020): None}
    audit = imputation.null_audit(df, imputation.fill_with_mean(df, ["k"], ["v"]), ["v"]).collect()
    assert [tuple(r) for r in audit] == [("v", 2, 1)]


def test_one_rule_for_groups_of_any_size(spark, monkeypatch):
    """Many small groups: hash aggregates only, and a small part of the rows is staged."""
    rng = random.Random(8)
    rows = [(i % 150, rng.lognormvariate(8, 1)) for i in range(60_000)]
    df = spark.createDataFrame(rows, "k int, v double").cache()
    staged, plans, real = {}, [], quantiles.stage

    def kept(frame, name):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return staged.setdefault(name, real(frame, name))

    monkeypatch.setattr(quantiles, "stage", kept)
    got = {r.k: r.m for r in quantiles.exact_median(df, ["k"], F.col("v"), "m").collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    assert got == {k: brute(g, 0.5, "disc") for k, g in groups.items()}
    assert sum(frame.count() for frame in staged.values()) < 0.1 * len(rows)
    assert all("SortAggregate" not in plan and "ObjectHashAggregate" not in plan for plan in plans)


def test_values_at_the_ends_of_the_range(spark):
    values = [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, float("inf"), float("-inf"), 1.0, 1.0 + 2**-52, 1.0 - 2**-53, -1.0, 1e-9, -1e-9, 3.0]
    df = spark.createDataFrame([("a", v) for v in values * 3] + [("b", 1e15 + i) for i in range(2000)], "k string, v double")
    wanted = {f"q{i}": i / 14 for i in range(15)}
    got = {r.k: r for r in quantiles.exact_quantiles(df, ["k"], F.col("v"), wanted).collect()}
    for k, own in (("a", values * 3), ("b", [1e15 + i for i in range(2000)])):
        for name, p in wanted.items():
            assert got[k][name] == brute(own, p, "disc"), (k, name)
