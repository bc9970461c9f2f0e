"""The daily batch: extract, transform, load, export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lumbung.plans.warehouse import Tables, build_warehouse, cube_of, load_warehouse, read_warehouse
from lumbung.session import staging_area
from lumbung.sources import indicators, sinks, versions
from lumbung.sources.readers import read_staging
from lumbung.sources.schemas import EVENT_TABLES, STAGING


def extract(
    folder: str, payloads: DataFrame, substitute: DataFrame, events: Mapping[str, DataFrame], prices: DataFrame,
) -> DataFrame:
    """Write all staging tables and return their row counts.

    ``payloads`` are the staged indicator documents, ``events`` the operational tables by name.
    A table that fails stops the extract, because the transform needs all of them.
    """
    tables = {
        "bps_api_raw": indicators.annual_statistics(payloads), "bps_dummy_raw": substitute,
        **{name: events[name] for name in EVENT_TABLES}, "pihps_raw": prices,
    }
    outcome = sinks.snapshot({f"{STAGING[name][0]}.parquet": df for name, df in tables.items()}, folder)
    failed = {name: error for name, error in outcome.items() if error}
    if failed:
        raise RuntimeError(f"extract failed for {sorted(failed)}") from next(iter(failed.values()))
    spark = payloads.sparkSession
    return sinks.row_counts({name: read_staging(spark, folder, STAGING[name][0]) for name in tables})


def staging_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_staging(spark, folder, table, schema) for name, (table, schema) in STAGING.items()}


def run_daily(
    spark: SparkSession, staging: str, output: str, warehouse: str, cube_csv: str | None = None, key_mode: str = "name",
    years: tuple[int, int] | None = None,
) -> Tables:
    """Build the warehouse from the staging area, save the outputs, check and load the star, export the cube.

    The star is checked and loaded from the saved output. What is staged on the way is deleted at
    the end, also after a failure. Regions keep the keys that the last loaded version gave them.
    """
    with staging_area(spark):
        last = versions.current(spark, warehouse)
        known = read_warehouse(spark, warehouse, last.number) if last else None
        tables = build_warehouse(staging_tables(spark, staging), key_mode, years, known)
        months = tables["dim_waktu"].select("waktu_key", "tahun")
        sinks.save_parquet({**tables, sinks.FACT: tables[sinks.FACT].join(months, "waktu_key")}, output)
        loaded = load_warehouse(sinks.read_back(spark, output, list(tables)), warehouse)
        if cube_csv:
            sinks.export_cube(cube_of(loaded), cube_csv)
    versions.drop_old(spark, warehouse, keep=7)
    return loaded
