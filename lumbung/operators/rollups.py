"""Aggregated views of the cube."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumbung.functions import dates, risk
from lumbung.functions.numeric import safe_ratio, stable_round

RISK = "supply_risk_index"
Bands = Sequence[tuple[float, str]]


def mean_by(cube: DataFrame, keys: Sequence[str], value: str = RISK, name: str = "avg_risk") -> DataFrame:
    return cube.groupBy(*keys).agg(F.avg(value).alias(name))


def index_statistics(fact: DataFrame) -> DataFrame:
    """One row: least, greatest, mean, sample deviation and median of the index, six decimals."""
    return fact.agg(
        *[
            stable_round(f"{f}({RISK})", 6).alias(name)
            for name, f in (("min", "min"), ("max", "max"), ("mean", "avg"), ("std", "stddev_samp"))
        ],
        F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {RISK}) AS median"),
    )


def load_summary(dim_prov: DataFrame, dim_komoditas: DataFrame, dim_waktu: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: sizes of all tables and the range of the index."""

    def size(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    return fact.agg(
        F.count(F.lit(1)).alias("n_fact"),
        stable_round(f"min({RISK})", 6).alias("risk_min"),
        stable_round(f"max({RISK})", 6).alias("risk_max"),
        stable_round(f"avg({RISK})", 6).alias("risk_avg"),
    ).select(
        size(dim_prov).alias("n_dim_prov"), size(dim_komoditas).alias("n_dim_komoditas"),
        size(dim_waktu).alias("n_dim_waktu"), "n_fact", "risk_min", "risk_max", "risk_avg",
    )


def kpi_tiles(cube: DataFrame, bands: Bands = risk.DASHBOARD_BANDS) -> DataFrame:
    """Mean index and the number of rows in each band."""
    (high, _), (mid, _) = bands
    r = F.col(RISK)
    return cube.agg(
        F.avg(r).alias("avg_risk"),
        F.count_if(r >= high).alias("n_bahaya"),
        F.count_if((r >= mid) & (r < high)).alias("n_waspada"),
        F.count_if(r < mid).alias("n_aman"),
    )


def zone_distribution(cube: DataFrame, bands: Bands = risk.DASHBOARD_BANDS) -> DataFrame:
    """Number of regions per band of their mean index."""
    means = mean_by(cube, ["nama_provinsi"])
    return means.groupBy(risk.band("avg_risk", bands).alias("zona")).agg(F.count(F.lit(1)).alias("n"))


def quarterly_trend(cube: DataFrame) -> DataFrame:
    trend = mean_by(cube, ["tahun", "kuartal"])
    return trend.withColumn("periode", dates.period_quarter(F.col("tahun"), F.col("kuartal")))


def latest_rows(df: DataFrame, group: str, time: str) -> DataFrame:
    """The rows of each group's own latest time key.

    The latest keys are an aggregate joined back, so that no task sorts a whole group.
    """
    latest = df.groupBy(group).agg(F.max(time).alias(time))
    return df.join(latest, [group, time], "left_semi")


def latest_status(cube: DataFrame, bands: Bands = risk.DASHBOARD_BANDS) -> DataFrame:
    """State of every region in its latest month, riskiest first."""
    now = latest_rows(cube, "nama_provinsi", "waktu_key").groupBy("nama_provinsi").agg(
        stable_round(f"avg({RISK})", 4).alias("risk"),
        stable_round("avg(avg_harga)", 0).alias("avg_harga"),
        F.coalesce(F.sum("sum_jumlah_sakit"), F.lit(0.0)).alias("sakit"),
    )
    return now.withColumn("status", risk.band("risk", bands)).orderBy(F.desc("risk"), "nama_provinsi")


def monthly_gap(cube: DataFrame) -> DataFrame:
    """Supply against the mean regional demand, per month and commodity."""
    out = cube.groupBy("tahun", "bulan", "nama_komoditas").agg(
        F.sum("sum_vol_mutasi").alias("sum_vol_mutasi"),
        F.avg("avg_permintaan_bulanan").alias("avg_permintaan"),
        F.sum("sum_realisasi_karkas").alias("sum_karkas"),
        F.avg("avg_konsumsi_bulanan").alias("avg_konsumsi"),
    )
    return out.withColumns(
        {
            "gap_ekor": F.col("sum_vol_mutasi") - F.col("avg_permintaan"),
            "gap_kg": F.col("sum_karkas") - F.col("avg_konsumsi"),
            "time_key": dates.period_number(F.col("tahun"), F.col("bulan")),
        }
    )


def gap_tiles(gaps: DataFrame) -> DataFrame:
    return gaps.agg(
        F.count_if(F.col("gap_ekor") > 0).alias("n_surplus"),
        F.count_if(F.col("gap_ekor") < 0).alias("n_defisit"),
        stable_round("avg(gap_ekor)", 0).alias("avg_gap_ekor"),
        stable_round("avg(gap_kg)", 0).alias("avg_gap_kg"),
    )


def supply_demand_series(cube: DataFrame, commodity: str) -> DataFrame:
    """Total carcass weight and total consumption per month of one commodity; 0 where nothing is known."""
    out = cube.where(F.col("nama_komoditas") == commodity).groupBy("tahun", "bulan", "nama_komoditas").agg(
        F.coalesce(F.sum("sum_realisasi_karkas"), F.lit(0.0)).alias("sum_realisasi_karkas"),
        F.coalesce(F.sum("avg_konsumsi_bulanan"), F.lit(0.0)).alias("avg_konsumsi_bulanan"),
    )
    return out.withColumn("tanggal", dates.period_dash(F.col("tahun"), F.col("bulan")))


def deficits(cube: DataFrame) -> DataFrame:
    """Region-commodities whose total movement stays below their total demand."""
    gap = F.sum("sum_vol_mutasi") - F.sum("avg_permintaan_bulanan")
    return cube.groupBy("nama_provinsi", "nama_komoditas").agg(gap.alias("gap")).where(F.col("gap") < 0)


def surplus_months(gaps: DataFrame) -> DataFrame:
    """Months of surplus and of deficit per commodity, one row each."""
    counts = gaps.groupBy("nama_komoditas").agg(
        F.count_if(F.col("gap_kg") > 0).alias("surplus"), F.count_if(F.col("gap_kg") < 0).alias("defisit")
    )
    return counts.unpivot(["nama_komoditas"], ["surplus", "defisit"], "status", "n")


def regional_summary(cube: DataFrame, bands: Bands = risk.DASHBOARD_BANDS) -> DataFrame:
    """One row per region for the map."""
    out = cube.groupBy("nama_provinsi").agg(
        F.avg(RISK).alias(RISK), F.avg("avg_harga").alias("avg_harga"),
        F.sum("sum_jumlah_sakit").alias("sum_jumlah_sakit"),
        F.sum("sum_vol_mutasi").alias("sum_vol_mutasi"), F.avg("populasi_ternak").alias("populasi_ternak"),
    )
    return out.withColumn("zona", risk.band(RISK, bands))


def disease_density(summary: DataFrame) -> DataFrame:
    """Sick animals per thousand kept: herd floored at one, and plainly with two decimals; null without a herd size."""
    sick, herd = F.col("sum_jumlah_sakit"), F.col("populasi_ternak")
    return summary.withColumns(
        {
            "disease_density": F.when(herd.isNotNull(), sick / (F.greatest(herd, F.lit(1.0)) / 1000)),
            "disease_density_2dp": stable_round(safe_ratio(sick, herd / 1000), 2),
        }
    )


def supply_concentration(cube: DataFrame) -> DataFrame:
    """Volume, herd and risk per region, largest supplier first, with shares.

    Shares run over one row per region, so the global windows are as small as the dimension.
    Equal volumes are ordered by name.
    """
    out = cube.groupBy("nama_provinsi").agg(
        F.sum("sum_vol_mutasi").alias("sum_vol"), F.avg("populasi_ternak").alias("pop"), F.avg(RISK).alias("risk")
    )
    order = W.orderBy(F.desc("sum_vol"), "nama_provinsi")
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    total = F.sum("sum_vol").over(W.partitionBy())
    return out.withColumns(
        {
            "pct": safe_ratio(F.col("sum_vol") * 100, total),
            "cumsum_pct": safe_ratio(F.sum("sum_vol").over(running) * 100, total),
        }
    )


def vulnerable(concentration: DataFrame, share: float = 10.0, index: float = 0.3) -> DataFrame:
    """Large and risky suppliers."""
    return concentration.where((F.col("pct") >= share) & (F.col("risk") >= index)).select(
        "nama_provinsi",
        stable_round("sum_vol", 0).alias("vol_supply"),
        stable_round("pct", 2).alias("pct_nasional"),
        stable_round("risk", 4).alias("avg_risk"),
    )


def executive_summary(cube: DataFrame, danger: float = 0.5, top: int = 3) -> DataFrame:
    """One row: mean index, regions that ever reached ``danger``, and the share of the top suppliers."""
    head = cube.agg(
        F.avg(RISK).alias("avg_risk"),
        F.count_distinct(F.when(F.col(RISK) >= danger, F.col("nama_provinsi"))).alias("n_kritis"),
    )
    best = supply_concentration(cube).orderBy(F.desc("sum_vol"), "nama_provinsi").limit(top)
    share = best.agg(F.sum("pct")).scalar()
    return head.withColumn("top_share", share)


def price_scatter(cube: DataFrame) -> DataFrame:
    """Mean price and total sick animals per month and commodity, complete pairs only."""
    return cube.groupBy("tahun", "bulan", "nama_komoditas").agg(
        F.avg("avg_harga").alias("avg_harga"), F.sum("sum_jumlah_sakit").alias("sum_sakit")
    ).dropna(subset=["avg_harga", "sum_sakit"])


def price_variation(cube: DataFrame) -> DataFrame:
    """Coefficient of variation of the price per region and commodity, most unstable first."""
    out = cube.groupBy("nama_provinsi", "nama_komoditas").agg(
        F.avg("avg_harga").alias("mean_h"), F.stddev_samp("avg_harga").alias("sd_h")
    )
    out = out.withColumn("cv", F.col("sd_h") / F.greatest(F.col("mean_h"), F.lit(1.0)) * 100)
    return out.where(F.col("cv").isNotNull()).orderBy(F.desc("cv"), "nama_provinsi", "nama_komoditas")


def number_profile(df: DataFrame, value: str, time: str) -> DataFrame:
    """One row: count, mean, deviation, range of a number, time range, nulls and their share."""
    missing = F.count_if(F.col(value).isNull())
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_values"),
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
        missing.alias("n_null"),
        stable_round(F.try_divide(missing * 100, F.count(F.lit(1))), 2).alias("pct_null"),
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) of every distinct value, in one pass over the table."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).distinct()


def rows_per(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)


def mean_price_by(df: DataFrame, keys: Sequence[str], value: str = "harga") -> DataFrame:
    return df.groupBy(*keys).agg(stable_round(F.avg(value), 0).alias("harga_rata2")).orderBy(*keys)
