"""Correlation of prices and outbreaks, also with a delay between regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumbung.functions import dates, statistics
from lumbung.functions.numeric import safe_ratio
from lumbung.operators.rollups import price_scatter


def price_outbreak_correlation(cube: DataFrame) -> DataFrame:
    """Pearson's r and p of national monthly price and sick animals, per commodity."""
    out = price_scatter(cube).groupBy("nama_komoditas").agg(
        F.count(F.lit(1)).alias("n"), statistics.pearson(F.col("avg_harga"), F.col("sum_sakit")).alias("r")
    )
    out = out.where(F.col("n") > 2).withColumn("p", statistics.correlation_p(F.col("r"), F.col("n")))
    return out.withColumns(
        {
            "kekuatan": statistics.strength(F.col("r")),
            "signifikan": F.coalesce(F.col("p") < 0.05, F.lit(False)),
        }
    )


def two_region_series(
    cube: DataFrame, upstream: Sequence[str], downstream: Sequence[str], commodity: str,
    measure: str = "sum_jumlah_sakit",
) -> DataFrame:
    """Months with the upstream total of a measure and the downstream mean price, numbered.

    One pass over the cube gives both sides; a month must have rows on both. The numbering runs
    over months, never over detail rows.
    """
    up, down = F.col("nama_provinsi").isin(*upstream), F.col("nama_provinsi").isin(*downstream)
    months = (
        cube.where((F.col("nama_komoditas") == commodity) & (up | down))
        .groupBy("tahun", "bulan")
        .agg(
            F.count_if(up).alias("_up"), F.count_if(down).alias("_down"),
            F.coalesce(F.sum(F.when(up, F.col(measure))), F.lit(0.0)).alias("x_wabah"),
            F.avg(F.when(down, F.col("avg_harga"))).alias("y_harga"),
        )
        .where((F.col("_up") > 0) & (F.col("_down") > 0))
        .drop("_up", "_down")
    )
    return months.withColumns(
        {
            "t": F.row_number().over(W.orderBy("tahun", "bulan")),
            "periode": dates.period_slash(F.col("tahun"), F.col("bulan")),
        }
    )


def lag_pairs(series: DataFrame, max_lag: int, calendar: bool = False) -> DataFrame:
    """(lag, t, x, y): x of row t with y of row t + lag, for every lag at once.

    Rows are months in order, so a missing month shortens the distance. With ``calendar`` the
    distance is in calendar months.
    """
    place = F.col("tahun") * 12 + F.col("bulan") if calendar else F.col("t")
    left = series.select(
        F.col("t"), place.alias("_at"), F.col("x_wabah").alias("x"),
        F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"),
    ).withColumn("_target", F.col("_at") + F.col("lag"))
    right = series.select(place.alias("_target"), F.col("y_harga").alias("y"))
    return left.join(right, "_target").select("lag", "t", "x", "y")


def lag_scan(series: DataFrame, max_lag: int = 6, min_pairs: int = 5, calendar: bool = False) -> DataFrame:
    """Correlation per lag. Too short a series gives no rows."""
    long_enough = series.agg(F.count(F.lit(1))).scalar() > max_lag + 2
    pairs = lag_pairs(series, max_lag, calendar).dropna(subset=["x", "y"])
    out = pairs.groupBy("lag").agg(
        F.count(F.lit(1)).alias("n"), statistics.pearson(F.col("x"), F.col("y")).alias("r")
    )
    out = out.where((F.col("n") >= min_pairs) & long_enough)
    return out.withColumn("p", statistics.correlation_p(F.col("r"), F.col("n")))


def short_lag_scan(series: DataFrame, max_lag: int = 4) -> DataFrame:
    """Correlation per lag with at least three pairs and no rule on the length of the series."""
    pairs = lag_pairs(series, max_lag).dropna(subset=["x", "y"])
    return pairs.groupBy("lag").agg(
        F.count(F.lit(1)).alias("n"), statistics.pearson(F.col("x"), F.col("y")).alias("r")
    ).where(F.col("n") > 2)


def peak_lag(scan: DataFrame) -> DataFrame:
    """The lag with the strongest correlation; equal strengths give the smaller lag."""
    best = F.max_by(F.struct("lag", "r", "p"), F.struct(F.abs("r"), -F.col("lag"))).alias("b")
    out = scan.where(F.col("r").isNotNull()).agg(best).where(F.col("b").isNotNull()).select("b.lag", "b.r", "b.p")
    return out.withColumn("signifikan", F.coalesce(F.col("p") < 0.05, F.lit(False)))


def labelled_scan(scan: DataFrame) -> DataFrame:
    """Lags with their verdict and a mark on the strongest one."""
    peak = peak_lag(scan).select("lag").scalar()
    return scan.withColumns(
        {
            "label_lag": F.concat(F.lit("Lag "), F.col("lag").cast("string")),
            "is_peak": F.coalesce(F.col("lag") == peak, F.lit(False)),
            "verdict": statistics.verdict(F.col("r"), F.col("p")),
        }
    )


def z_score(value: str) -> F.Column:
    everything = W.partitionBy()
    return safe_ratio(F.col(value) - F.avg(value).over(everything), F.stddev_samp(value).over(everything))


def overlay(series: DataFrame, scan: DataFrame, default_lag: int = 2) -> DataFrame:
    """Standardised downstream price and upstream measure, the latter moved by the best lag.

    The shift is a join on the row number, because the lag is itself a result of the job.
    """
    best = F.coalesce(peak_lag(scan).select("lag").scalar(), F.lit(default_lag))
    moved = series.select((F.col("t") + best).alias("t"), F.col("x_wabah").alias("wabah_shifted"))
    out = series.join(moved, "t", "left")
    return out.select(
        "tahun", "bulan", "periode", "t", "y_harga", "wabah_shifted",
        z_score("y_harga").alias("z_harga"), z_score("wabah_shifted").alias("z_wabah"),
    )
