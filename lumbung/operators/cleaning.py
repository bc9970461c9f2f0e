"""Typed, cleaned copies of raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import dates, numeric, text
from lumbung.sources.literals import alias_table


def clean_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Locale-formatted text columns to doubles."""
    return df.withColumns({c: numeric.local_number(F.col(c)) for c in columns})


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; text that does not fit becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def clean_events(df: DataFrame, date_column: str, types: Mapping[str, str]) -> DataFrame:
    """Event table with a parsed date, its month and year, and typed measures."""
    return typed(dates.with_event_date(df, date_column), types)


def canonical_names(df: DataFrame, column: str, aliases: Mapping[str, str]) -> DataFrame:
    """Replace known spellings by their canonical name; other names stay as they are.

    A join with the literal alias table: it is broadcast, so the rows are hashed once each and
    not shuffled.
    """
    table = alias_table(df.sparkSession, aliases).toDF("_alias", "_canonical")
    joined = df.withColumn("_alias", text.upper_key(F.col(column))).join(table, "_alias", "left")
    return joined.withColumn(column, F.coalesce("_canonical", column)).select(*df.columns)


def clean_prices(
    df: DataFrame, aliases: Mapping[str, str],
    labels: Mapping[str, str] | None = None, label_column: str = "nama_komoditas",
) -> DataFrame:
    """Price rows with types, day, month, year, commodity label and canonical region."""
    labels = labels or {"sapi": "Sapi", "ayam": "Ayam"}
    when = F.col("waktu").cast("string").try_cast("timestamp_ntz")
    out = df.withColumns(
        {"waktu": when, "harga": F.col("harga").cast("string").try_cast("double"),
         "nama_komoditas": text.label_by_content(F.col(label_column), labels)}
    )
    out = out.withColumns(
        {"tgl": F.to_date("waktu"), "bulan": F.month("waktu"), "tahun": F.year("waktu")}
    )
    return canonical_names(out, "provinsi", aliases)


def drop_empty_and_repeated(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Drop rows without any measure, then whole-row duplicates."""
    return df.dropna(how="all", subset=list(measures)).dropDuplicates()


def zero_if_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})


def keep_known(df: DataFrame, column: str, known: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(*known))


def monthly_rates(df: DataFrame, population_scale: float = 1.0, tonne_ids: Sequence[int] = (1,)) -> DataFrame:
    """Annual statistics as average months.

    Production of the ``tonne_ids`` commodities is turned into kilograms. Consumption is per
    head: it is multiplied by the inhabitants (times ``population_scale``) where they are known.
    """
    ids = ", ".join(map(str, tonne_ids))
    people = f"CASE WHEN jumlah_penduduk > 0 THEN jumlah_penduduk * {population_scale}D ELSE 1D END"
    rates = {
        "populasi_ternak": "populasi",
        "avg_produksi_bulanan": f"produksi_daging * CASE WHEN id_komoditas IN ({ids}) THEN 1000D ELSE 1D END / 12D",
        "avg_konsumsi_bulanan": f"konsumsi_daging * {people} / 12D",
        "avg_permintaan_bulanan": "permintaan_daging / 12D",
        "avg_pemotongan_bulanan": "jumlah_ternak_potong / 12D",
    }
    return df.withColumns({name: F.expr(rate) for name, rate in rates.items()})


ROUNDING = {
    "avg_harga": 2, "harga_baseline": 2, "populasi_ternak": 0, "avg_produksi_bulanan": 2,
    "avg_konsumsi_bulanan": 2, "avg_pemotongan_bulanan": 2, "avg_permintaan_bulanan": 2,
}


def round_outputs(df: DataFrame) -> DataFrame:
    """Output precision of the fact table; inhabitants become whole numbers (truncated)."""
    columns = {c: numeric.stable_round(c, d) for c, d in ROUNDING.items()}
    return df.withColumns({**columns, "jumlah_penduduk": F.expr("CAST(jumlah_penduduk AS bigint)")})


def global_filter(df: DataFrame, **equal: object) -> DataFrame:
    """Optional equality filters; ``None`` and "Semua" switch one off."""
    for column, wanted in equal.items():
        if wanted is not None and wanted != "Semua":
            df = df.where(F.col(column) == F.lit(wanted))
    return df
