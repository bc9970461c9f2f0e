"""All result sets of the dashboard and of the analysis notebook over one cube."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions import dates, risk
from lumbung.operators import conform, correlation, quantiles, ranking, reshape, rollups
from lumbung.operators.cleaning import global_filter
from lumbung.session import stage
from lumbung.sources.fixed_values import DEFAULT_DOWNSTREAM, DEFAULT_UPSTREAM, REGION_CENTRES
from lumbung.sources.literals import literal_table

ResultSets = dict[str, DataFrame]


def _period() -> Column:
    return dates.period_slash(F.col("tahun"), F.col("bulan"))


def month_labels(cube: DataFrame) -> list[str]:
    """Month labels of the cube, in order: at most one per month of the time dimension."""
    rows = cube.select("tahun", "bulan").distinct().orderBy("tahun", "bulan").collect()
    return [f"{r.tahun}/{r.bulan:02d}" for r in rows]


def _upper(names: Sequence[str]) -> list[str]:
    return [name.strip().upper() for name in names]


def _upper_names(cube: DataFrame) -> DataFrame:
    return cube.withColumn("nama_provinsi", F.upper(F.trim("nama_provinsi")))


def dashboard(
    cube: DataFrame, commodity: str | None = None, year: int | None = None, region: str | None = None,
    map_year: int | str | None = None, map_commodity: str | None = None, upstream: Sequence[str] = DEFAULT_UPSTREAM,
    downstream: Sequence[str] = DEFAULT_DOWNSTREAM, lag_commodity: str = "Sapi", lag_measure: str = "sum_jumlah_sakit",
    max_lag: int = 6, supply_regions: Sequence[str] | None = None, bands: rollups.Bands = risk.DASHBOARD_BANDS,
) -> ResultSets:
    """Result sets by name; regions are compared in upper case by the lag analysis.

    The first three arguments are the global filters. Correlations, the lag analysis and the map
    use the whole cube, as they have filters of their own; the map shows ``map_year``, the newest
    year if none is given, all years for "Semua". Pass a stored cube: each result reads it. The
    sets are lazy, but for the monthly series of the lag analysis, which is staged, and the month
    labels of the heatmaps, which are collected.
    """
    rows = global_filter(cube, nama_komoditas=commodity, tahun=year, nama_provinsi=region)
    heat_commodity = lag_commodity if commodity in (None, "Semua") else commodity
    gaps = rollups.monthly_gap(rows)
    newest = cube.agg(F.max("tahun").alias("tahun"))
    map_rows = cube.join(newest, "tahun", "left_semi") if map_year is None else global_filter(cube, tahun=map_year)
    regional = rollups.regional_summary(global_filter(map_rows, nama_komoditas=map_commodity), bands)
    centres = literal_table(cube.sparkSession, ["nama_provinsi", "lat", "lon"], REGION_CENTRES)
    suppliers = rows if supply_regions is None else rows.where(F.col("nama_provinsi").isin(*supply_regions))
    supply = rollups.supply_concentration(suppliers)
    series = stage(
        correlation.two_region_series(_upper_names(cube), _upper(upstream), _upper(downstream), lag_commodity, lag_measure),
        "lag-series",
    )
    scan = correlation.lag_scan(series, max_lag)
    prices = cube.where((F.col("nama_komoditas") == heat_commodity) & F.col("avg_harga").isNotNull())
    periods = month_labels(cube)
    return {
        "kpi": rollups.kpi_tiles(rows, bands),
        "zone_distribution": rollups.zone_distribution(rows, bands),
        "quarterly_trend": rollups.quarterly_trend(rows),
        "latest_status": rollups.latest_status(rows, bands),
        "top_regions": ranking.top_regions(rows, 10).withColumn("status", risk.band("avg_risk", bands)),
        "top_timeline": ranking.top_region_timeline(rows, 5),
        "risk_heatmap": reshape.heatmap(rows, "nama_provinsi", _period(), rollups.RISK, periods),
        "correlation": correlation.price_outbreak_correlation(cube),
        "price_scatter": rollups.price_scatter(rows),
        "price_box_quarter": quantiles.five_numbers(rows, ["kuartal", "nama_komoditas"], "avg_harga"),
        "lag_scan": correlation.labelled_scan(scan),
        "lag_peak": correlation.peak_lag(scan),
        "lag_overlay": correlation.overlay(series, scan),
        "monthly_gap": gaps,
        "gap_tiles": rollups.gap_tiles(gaps),
        "supply_demand": rollups.supply_demand_series(rows, "Sapi"),
        "deficits": ranking.deepest_deficits(rollups.deficits(rows), 12),
        "surplus_months": rollups.surplus_months(gaps),
        "map": regional,
        "map_bubbles": conform.centre_join(centres, regional),
        "map_missing": conform.without_centre(centres, regional),
        "disease_density": rollups.disease_density(regional),
        "pareto": ranking.top_suppliers(supply, 15),
        "treemap": supply.select("nama_provinsi", "sum_vol", "pct"),
        "vulnerable": rollups.vulnerable(supply),
        "price_box_period": quantiles.five_numbers(
            rows.withColumn("periode", _period()), ["periode", "nama_komoditas"], "avg_harga"
        ),
        "price_variation": rollups.price_variation(rows),
        "price_heatmap": reshape.heatmap(prices, "nama_provinsi", _period(), "avg_harga", periods),
        "years": ranking.choices(cube, "tahun", descending=True),
        "regions": ranking.choices(cube, "nama_provinsi"),
    }


def notebook(
    cube: DataFrame, upstream: Sequence[str] = DEFAULT_UPSTREAM, downstream: Sequence[str] = DEFAULT_DOWNSTREAM,
    commodity: str = "Sapi",
) -> ResultSets:
    """Result sets of the analysis notebook, lazy but for the staged lag series; regions are compared in upper case."""
    series = stage(
        correlation.two_region_series(_upper_names(cube), _upper(upstream), _upper(downstream), commodity), "lag-series"
    )
    density = rollups.disease_density(rollups.regional_summary(cube))
    supply = rollups.supply_concentration(cube)
    return {
        "top_timeline": ranking.top_region_timeline(cube, 5).withColumn("zona", risk.band("risk", risk.NOTEBOOK_BANDS)),
        "lag_scan": correlation.short_lag_scan(series, 4),
        "supply_demand": rollups.supply_demand_series(cube, commodity),
        "disease_density": density.select(
            "nama_provinsi", "populasi_ternak", "sum_jumlah_sakit", rollups.RISK,
            F.col("disease_density_2dp").alias("disease_density"),
        ),
        "pareto": ranking.top_suppliers(supply, 10).withColumn("status", risk.above("risk", 0.3)),
        "price_box_month": quantiles.five_numbers(cube, ["bulan", "nama_komoditas"], "avg_harga"),
        "summary": rollups.executive_summary(cube, danger=0.5),
        "top_suppliers": ranking.top_suppliers(supply, 3),
    }
