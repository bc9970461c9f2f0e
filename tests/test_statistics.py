"""Correlation and significance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumbung.functions import statistics
from lumbung.operators import correlation


def t_tail(r, n):
    """Two-sided p-value by numerical integration of Student's density."""
    v = n - 2
    t = abs(r) * math.sqrt(v / (1 - r * r))
    x = np.linspace(0, 1, 400_001)[1:-1]
    # Substituting u = t + x / (1 - x) maps the tail to (0, 1).
    u = t + x / (1 - x)
    c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    density = c * (1 + u * u / v) ** (-(v + 1) / 2) / (1 - x) ** 2
    return 2 * float(np.trapezoid(density, x))


@pytest.mark.parametrize("n", [3, 4, 5, 6, 7, 12, 13, 40, 81])
def test_p_value(spark, n):
    rs = [0.0, 0.1, -0.35, 0.6, 0.9, -0.99]
    df = spark.createDataFrame([(r, n) for r in rs], "r double, n int")
    got = [x[0] for x in df.select(statistics.correlation_p(F.col("r"), F.col("n"))).collect()]
    for r, p in zip(rs, got):
        assert p == pytest.approx(t_tail(r, n), abs=2e-5)


def test_p_value_edges(spark):
    df = spark.createDataFrame([(1.0, 5), (-1.0, 5), (0.5, 2), (None, 9)], "r double, n int")
    got = [x[0] for x in df.select(statistics.correlation_p(F.col("r"), F.col("n"))).collect()]
    assert got == [0.0, 0.0, None, None]


def test_constant_side_gives_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert df.agg(statistics.pearson(F.col("x"), F.col("y"))).first()[0] is None


def series(spark, n=20, skip=()):
    months = [(2020 + i // 12, i % 12 + 1, i) for i in range(n) if i not in skip]
    rows = [
        (y, m, t + 1, f"{y}/{m:02d}", float((i * 7) % 11), float(((i - 2) * 7) % 11)) for t, (y, m, i) in enumerate(months)
    ]
    return spark.createDataFrame(rows, "tahun int, bulan int, t int, periode string, x_wabah double, y_harga double")


def test_lag_scan_finds_the_delay(spark):
    s = series(spark)
    scan = {r.lag: r for r in correlation.lag_scan(s, 6).collect()}
    assert sorted(scan) == list(range(7))
    assert [scan[k].n for k in range(7)] == [20 - k for k in range(7)]
    assert scan[2].r == pytest.approx(1.0)
    x = np.array([r.x_wabah for r in s.collect()])
    y = np.array([r.y_harga for r in s.collect()])
    for k in range(7):
        assert scan[k].r == pytest.approx(np.corrcoef(x[: 20 - k], y[k:])[0, 1])
    peak = correlation.peak_lag(correlation.lag_scan(s, 6)).first()
    assert (peak.lag, peak.signifikan) == (2, True)
    marks = {r.lag: (r.is_peak, r.verdict) for r in correlation.labelled_scan(correlation.lag_scan(s, 6)).collect()}
    assert marks[2] == (True, "signifikan positif") and not marks[3][0]


def test_too_short_a_series_gives_no_lags(spark):
    assert correlation.lag_scan(series(spark, 8), 6).count() == 0
    assert correlation.short_lag_scan(series(spark, 5), 4).count() == 3


def test_row_offset_and_calendar_lag_differ_after_a_missing_month(spark):
    s = series(spark, 20, skip=(9,))
    rows = {(r.t, r.lag): r.y for r in correlation.lag_pairs(s, 2).collect()}
    calendar = {(r.t, r.lag): r.y for r in correlation.lag_pairs(s, 2, calendar=True).collect()}
    assert (9, 1) in rows and (9, 1) not in calendar
    assert calendar[(9, 2)] == rows[(9, 1)]


def test_equal_peaks_take_the_smaller_lag(spark):
    scan = spark.createDataFrame([(3, 0.5, 0.2), (1, -0.5, 0.2), (2, 0.1, 0.9), (0, None, None)], "lag int, r double, p double")
    assert correlation.peak_lag(scan).first().lag == 1


def test_overlay_shifts_by_the_best_lag(spark):
    s = series(spark)
    out = {r.t: r for r in correlation.overlay(s, correlation.lag_scan(s, 6)).collect()}
    x = {r.t: r.x_wabah for r in s.collect()}
    assert out[1].wabah_shifted is None and out[2].wabah_shifted is None
    assert all(out[t].wabah_shifted == x[t - 2] for t in range(3, 21))
    z = np.array([out[t].z_harga for t in range(1, 21)])
    assert z.mean() == pytest.approx(0, abs=1e-9) and z.std(ddof=1) == pytest.approx(1)


def test_overlay_falls_back_to_two(spark):
    s = series(spark, 7)
    out = {r.t: r.wabah_shifted for r in correlation.overlay(s, correlation.lag_scan(s, 6)).collect()}
    x = {r.t: r.x_wabah for r in s.collect()}
    assert out[3] == x[1]
