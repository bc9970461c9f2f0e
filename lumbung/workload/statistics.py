"""Correlation, significance and dispersion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions.statistics import correlation_p, pearson
from lumbung.operators import correlation, rollups
from lumbung.operators.quantiles import five_numbers
from lumbung.plans import standin
from lumbung.plans.standin import Source
from lumbung.session import stage
from lumbung.workload.base import CUBE, on_cube, on_lines, query, r, tidy
from lumbung.workload.joins import DOWNSTREAM, UPSTREAM, series_sql


def p_sql(r_name: str = "r", n_name: str = "n") -> str:
    """Two-sided p-value with the coefficients written as gamma functions."""
    v, s, c = f"({n_name} - 2)", f"abs({r_name})", f"(1 - {r_name} * {r_name})"
    odd = (
        f"2 / pi() * (asin({s}) + {s} * coalesce(list_sum(list_transform(range(0, CAST(({v} - 1) // 2 AS BIGINT)), "
        f"lambda k: sqrt(pi()) / 2 * exp(lgamma(k + 1) - lgamma(k + 1.5)) * sqrt({c}) * pow({c}, k))), 0))"
    )
    even = (
        f"{s} * coalesce(list_sum(list_transform(range(0, CAST({v} // 2 AS BIGINT)), "
        f"lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1)) / sqrt(pi()) * pow({c}, k))), 0)"
    )
    return f"greatest(0, 1 - CASE WHEN {v} % 2 = 1 THEN {odd} ELSE {even} END)"


PAIRS = """pairs AS (
  SELECT CAST(lag AS INTEGER) AS lag, a.t, a.x_wabah AS x, b.y_harga AS y FROM series a
  CROSS JOIN (SELECT unnest(generate_series(0, {max_lag})) AS lag) JOIN series b ON b.t = a.t + lag)"""
SCAN = f"""scan AS (
  SELECT *, {p_sql()} AS p FROM (SELECT lag, count(*) AS n, corr(x, y) AS r FROM pairs GROUP BY lag HAVING count(*) >= 5))"""
SERIES = series_sql(UPSTREAM, DOWNSTREAM, "SMALL")


def series_of(t: Source) -> DataFrame:
    """The upstream and downstream series, staged because lag analyses read it several times."""
    return stage(correlation.two_region_series(standin.cube(t), UPSTREAM, DOWNSTREAM, "SMALL"), "series")


@query("k1_price_outbreak_correlation", f"""WITH {CUBE}, m AS (
  SELECT tahun, bulan, nama_komoditas, avg(avg_harga) AS h, sum(sum_jumlah_sakit) AS s FROM cube GROUP BY ALL),
c AS (SELECT nama_komoditas, count(*) AS n, corr(h, s) AS r FROM m GROUP BY 1 HAVING count(*) > 2)
SELECT nama_komoditas, n, {r("r", 6)} AS r, {r("p", 6)} AS p,
       CASE WHEN abs(r) >= 0.7 THEN 'kuat' WHEN abs(r) >= 0.5 THEN 'sedang' ELSE 'lemah' END AS kekuatan, p < 0.05 AS signifikan
FROM (SELECT *, {p_sql()} AS p FROM c)""")
def price_outbreak_correlation(t: Source) -> DataFrame:
    return tidy(correlation.price_outbreak_correlation(standin.cube(t)), {"r": 6, "p": 6})


@query("k2_lag_scan", f"""WITH {CUBE}, {SERIES}, {PAIRS.format(max_lag=6)}, {SCAN}
SELECT lag, n, {r("r", 6)} AS r, {r("p", 6)} AS p FROM scan""")
def lag_scan(t: Source) -> DataFrame:
    return tidy(correlation.lag_scan(series_of(t), 6), {"r": 6, "p": 6})


@query("k2_short_lag_scan", f"""WITH {CUBE}, {SERIES}, {PAIRS.format(max_lag=4)}
SELECT lag, count(*) AS n, {r("corr(x, y)", 6)} AS r FROM pairs GROUP BY lag HAVING count(*) > 2""")
def short_lag_scan(t: Source) -> DataFrame:
    return tidy(correlation.short_lag_scan(series_of(t), 4), {"r": 6})


@query("k3_t_test_p", on_lines(f"""
SELECT id_asal, n, {r("r", 6)} AS r, {r("p", 6)} AS p FROM (SELECT *, {p_sql()} AS p FROM (
  SELECT id_asal, count(*) AS n, corr(q, h) AS r FROM (
    SELECT id_asal, tahun, bulan, sum(l_quantity) AS q, avg(l_extendedprice / l_quantity) AS h FROM lines GROUP BY ALL) GROUP BY 1))"""))
def t_test_p(t: Source) -> DataFrame:
    months = standin.lines(t, commodity=False).groupBy("id_asal", "tahun", "bulan").agg(
        F.sum("l_quantity").alias("q"), F.expr(f"avg({standin.UNIT_PRICE}) AS h")
    )
    out = months.groupBy("id_asal").agg(F.count(F.lit(1)).alias("n"), pearson(F.col("q"), F.col("h")).alias("r"))
    return tidy(out.withColumn("p", correlation_p(F.col("r"), F.col("n"))), {"r": 6, "p": 6})


@query("k4_lag_verdicts", f"""WITH {CUBE}, {SERIES}, {PAIRS.format(max_lag=6)}, {SCAN}
SELECT lag, n, {r("r", 6)} AS r, {r("p", 6)} AS p, 'Lag ' || lag AS label_lag,
       lag = (SELECT lag FROM scan ORDER BY abs(r) DESC, lag LIMIT 1) AS is_peak,
       CASE WHEN p < 0.05 AND r > 0 THEN 'signifikan positif' WHEN p < 0.05 AND r < 0 THEN 'signifikan negatif'
            ELSE 'tidak signifikan' END AS verdict FROM scan""")
def lag_verdicts(t: Source) -> DataFrame:
    return tidy(correlation.labelled_scan(correlation.lag_scan(series_of(t), 6)), {"r": 6, "p": 6})


@query("k5_overlay", f"""WITH {CUBE}, {SERIES}, {PAIRS.format(max_lag=6)}, {SCAN},
moved AS (SELECT t + (SELECT lag FROM scan ORDER BY abs(r) DESC, lag LIMIT 1) AS t, x_wabah AS wabah_shifted FROM series),
both_sides AS (SELECT s.*, wabah_shifted FROM series s LEFT JOIN moved USING (t))
SELECT tahun, bulan, tahun || '/' || lpad(CAST(bulan AS VARCHAR), 2, '0') AS periode, t, {r("y_harga", 4)} AS y_harga, wabah_shifted,
       {r("(y_harga - avg(y_harga) OVER ()) / stddev_samp(y_harga) OVER ()", 6)} AS z_harga,
       {r("(wabah_shifted - avg(wabah_shifted) OVER ()) / stddev_samp(wabah_shifted) OVER ()", 6)} AS z_wabah FROM both_sides""")
def overlay(t: Source) -> DataFrame:
    series = series_of(t)
    return tidy(correlation.overlay(series, correlation.lag_scan(series, 6)), {"y_harga": 4, "z_harga": 6, "z_wabah": 6})


@query("k6_price_variation", on_cube(f"""
SELECT nama_provinsi, nama_komoditas, {r("m", 4)} AS mean_h, {r("s", 4)} AS sd_h, {r("s / greatest(m, 1) * 100", 4)} AS cv FROM (
  SELECT nama_provinsi, nama_komoditas, avg(avg_harga) AS m, stddev_samp(avg_harga) AS s FROM cube GROUP BY ALL) WHERE s IS NOT NULL"""))
def price_variation(t: Source) -> DataFrame:
    return tidy(rollups.price_variation(standin.cube(t)), {"mean_h": 4, "sd_h": 4, "cv": 4})


BOX = ("q0", "q1", "q2", "q3", "q4", "lower_fence", "upper_fence", "lower_whisker", "upper_whisker")


def box_sql(source: str, keys: str, value: str) -> str:
    return f"""box AS (
  SELECT {keys}, quantile_cont({value}, 0.0) AS q0, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS q2,
         quantile_cont({value}, 0.75) AS q3, quantile_cont({value}, 1.0) AS q4 FROM {source} GROUP BY {keys}),
fenced AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM box),
boxes AS (
  SELECT f.*, count(*) AS n, count(*) FILTER ({value} < lower_fence OR {value} > upper_fence) AS n_outliers,
         min({value}) FILTER ({value} >= lower_fence AND {value} <= upper_fence) AS lower_whisker,
         max({value}) FILTER ({value} >= lower_fence AND {value} <= upper_fence) AS upper_whisker
  FROM {source} s JOIN fenced f USING ({keys}) GROUP BY ALL)"""


BOX_SELECT = "n, n_outliers, " + ", ".join(f"{r(c, 4)} AS {c}" for c in BOX)


@query("k7_box_by_quarter", f"""WITH {CUBE}, {box_sql("cube", "kuartal, nama_komoditas", "avg_harga")}
SELECT kuartal, nama_komoditas, {BOX_SELECT} FROM boxes""")
def box_by_quarter(t: Source) -> DataFrame:
    return tidy(five_numbers(standin.cube(t, staged=True), ["kuartal", "nama_komoditas"], "avg_harga"), dict.fromkeys(BOX, 4))


@query("k7_box_by_month", f"""WITH {CUBE}, {box_sql("cube", "bulan, nama_komoditas", "avg_harga")}
SELECT bulan, nama_komoditas, {BOX_SELECT} FROM boxes""")
def box_by_month(t: Source) -> DataFrame:
    return tidy(five_numbers(standin.cube(t, staged=True), ["bulan", "nama_komoditas"], "avg_harga"), dict.fromkeys(BOX, 4))


@query("k7_box_by_period", f"""WITH {CUBE}, {box_sql("cube", "tahun, bulan, nama_komoditas", "avg_harga")}
SELECT tahun, bulan, nama_komoditas, {BOX_SELECT} FROM boxes""")
def box_by_period(t: Source) -> DataFrame:
    return tidy(five_numbers(standin.cube(t, staged=True), ["tahun", "bulan", "nama_komoditas"], "avg_harga"), dict.fromkeys(BOX, 4))


@query("k7_box_of_lines", f"""WITH {box_sql("lineitem", "l_returnflag", "l_extendedprice")}
SELECT l_returnflag, {BOX_SELECT} FROM boxes""")
def box_of_lines(t: Source) -> DataFrame:
    return tidy(five_numbers(t("lineitem"), ["l_returnflag"], "l_extendedprice", detail=True), dict.fromkeys(BOX, 4))
