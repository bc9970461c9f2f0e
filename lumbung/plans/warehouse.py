"""From raw staging tables to the star schema, its checks and its load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions import text
from lumbung.operators import cleaning, conform, dimensions, imputation, index, measures, quality, reshape, star
from lumbung.session import stage
from lumbung.sources import sinks, versions
from lumbung.sources.fixed_values import REGION_ALIASES
from lumbung.sources.readers import TableNotFound

API_NUMBERS = ["jumlah_penduduk", "populasi_sapi", "populasi_ayam", "produksi_daging_ayam"]
ANNUAL_MEASURES = ["populasi", "produksi_daging", "konsumsi_daging", "permintaan_daging", "jumlah_ternak_potong"]
EVENT_SUMS = ["sum_jumlah_sakit", "sum_jumlah_mati", "sum_vol_mutasi", "sum_realisasi_karkas"]
ANIMAL_CODES = {"sapi": 1, "ayam": 2}

Tables = dict[str, DataFrame]


def integrate(
    monthly: DataFrame, annual: DataFrame, demography: DataFrame, demography_keys: Sequence[str] = ("id_wilayah", "tahun"),
) -> DataFrame:
    """Monthly measures with the monthly share of their annual statistics."""
    rates = cleaning.monthly_rates(measures.with_demography(annual, demography, demography_keys)).select(
        "id_wilayah", "tahun", "id_komoditas", "populasi_ternak", "harga_baseline", "avg_produksi_bulanan",
        "avg_konsumsi_bulanan", "avg_permintaan_bulanan", "avg_pemotongan_bulanan", "jumlah_penduduk",
        "growth_populasi",
    )
    return cleaning.zero_if_null(measures.month_by_year(monthly, rates), EVENT_SUMS)


def risk_fact(integrated: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Price gaps filled, index computed over all rows, surrogate keys, output precision.

    ``integrated`` should be staged, as the medians read it too. The components are staged here:
    both the bounds and the scaled rows come from them.
    """
    components = stage(index.with_components(imputation.fill_price_gaps(integrated)), "components")
    keyed = star.with_keys(index.with_index(components), dims["dim_prov"], dims["dim_komoditas"], dims["dim_waktu"])
    return star.align(cleaning.round_outputs(keyed))


def _annual_sources(staging: Mapping[str, DataFrame]) -> DataFrame:
    api = cleaning.clean_numbers(staging["bps_api_raw"], API_NUMBERS)
    api = cleaning.canonical_names(cleaning.typed(api, {"tahun": "int"}), "provinsi", REGION_ALIASES)
    substitute = cleaning.typed(staging["bps_dummy_raw"], {"tahun": "int"})
    substitute = cleaning.canonical_names(substitute, "provinsi", REGION_ALIASES)
    return conform.merge_statistics(api, substitute)


def _event_sums(staging: Mapping[str, DataFrame]) -> list[DataFrame]:
    animals = staging["ref_hewan"].select("id_hewan", text.code_by_name("nama_hewan", ANIMAL_CODES).alias("id_komoditas"))
    reports = cleaning.clean_events(
        staging["tr_laporan_sakit"], "tgl_lapor",
        {"id_wilayah": "int", "jumlah_gejala": "double", "jumlah_mati": "double"},
    )
    moves = cleaning.clean_events(
        staging["tr_mutasi"], "tgl_mutasi", {"id_asal": "int", "id_tujuan": "int", "jumlah_ekor": "double"}
    )
    slaughter = cleaning.clean_events(staging["tr_rph"], "tgl_potong", {"id_wilayah": "int", "berat_karkas": "double"})
    return [
        measures.monthly_sums(
            reports, "id_wilayah", "tgl_lapor",
            {"sum_jumlah_sakit": "jumlah_gejala", "sum_jumlah_mati": "jumlah_mati"}, animals,
        ),
        measures.monthly_sums(moves, "id_asal", "tgl_mutasi", {"sum_vol_mutasi": "jumlah_ekor"}, animals),
        measures.monthly_sums(slaughter, "id_wilayah", "tgl_potong", {"sum_realisasi_karkas": "berat_karkas"}, animals),
    ]


def _renumber(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Sums by source region id as sums by dimension id."""
    sums = [c for c in df.columns if c not in measures.KEYS]
    mapped = df.join(crosswalk, "id_wilayah", "inner").drop("id_wilayah").withColumnRenamed("id_prov", "id_wilayah")
    return mapped.groupBy(*measures.KEYS).agg(*[F.sum(c).alias(c) for c in sums])


def build_warehouse(
    staging: Mapping[str, DataFrame], key_mode: str = "name", years: tuple[int, int] | None = None,
    known: Mapping[str, DataFrame] | None = None,
) -> Tables:
    """All output tables from the staging tables.

    Staging tables: bps_api_raw, bps_dummy_raw, ref_hewan, ref_wilayah, tr_mutasi,
    tr_laporan_sakit, tr_rph, pihps_raw.

    Regions are matched by canonical name. ``key_mode="ordinal"`` instead takes the events'
    region ids for the alphabetical rank of the statistics' regions, whatever their names.
    ``years`` fixes the span of the time dimension; otherwise it follows the statistics. ``known``
    has dim_prov and dim_waktu of an earlier run: its regions and months keep their keys, new ones
    come behind them.
    """
    ordinal = key_mode == "ordinal"
    master = stage(_annual_sources(staging), "statistics")
    regions = dimensions.region_ids(master)
    event_regions = cleaning.canonical_names(
        staging["ref_wilayah"].select(F.col("id_wilayah").try_cast("int").alias("id_wilayah"), "provinsi"),
        "provinsi", REGION_ALIASES,
    )
    same_id = F.col("l.id_wilayah") == F.col("r.id_wilayah")
    wilayah = conform.reconcile_regions(regions, event_regions, same_id if ordinal else None)
    dim_prov = stage(dimensions.region_dimension(wilayah, known=known and known["dim_prov"]), "dim-prov")
    dim_komoditas = dimensions.commodity_dimension(master.sparkSession)

    if ordinal:
        ids = regions
    else:
        ids = dim_prov.select(F.col("id_prov").alias("id_wilayah"), F.col("nama_provinsi").alias("provinsi"))
    mapped = conform.replace_name_by_id(master, ids)
    demography = reshape.one_per_key(
        mapped.select("id_wilayah", "tahun", "jumlah_penduduk", "growth_populasi"), ["id_wilayah", "tahun"],
        [F.col("jumlah_penduduk"), F.col("growth_populasi")],
    )
    annual = imputation.fill_with_mean(
        reshape.commodity_rows(mapped), ["id_wilayah", "id_komoditas"], ANNUAL_MEASURES
    )

    sums = _event_sums(staging)
    if not ordinal:
        crosswalk = conform.join_by_name(event_regions, dim_prov, "provinsi", "nama_provinsi", "inner")
        sums = [_renumber(df, crosswalk.select("id_wilayah", "id_prov")) for df in sums]
    prices = staging["pihps_raw"]
    label = "nama_komoditas" if "nama_komoditas" in prices.columns else "jenis_daging"
    prices = cleaning.clean_prices(prices, REGION_ALIASES, label_column=label)
    prices = stage(prices.select("provinsi", "nama_komoditas", "tahun", "bulan", "harga"), "prices")
    sums_of_prices = imputation.sums_filled_with_median(prices, ["provinsi", "nama_komoditas", "bulan"], ["tahun"], "harga")
    price = measures.mean_price(sums_of_prices, dim_prov, text.code_by_name("nama_komoditas", ANIMAL_CODES))
    monthly = cleaning.keep_known(measures.merge_measures([*sums, price]), "id_komoditas", [1, 2])

    bounds = master.select(F.lit(years[0]).alias("first"), F.lit(years[1]).alias("last")).limit(1) if years else (
        dimensions.year_bounds(annual)
    )
    dims = {
        "dim_prov": dim_prov,
        "dim_komoditas": dim_komoditas,
        "dim_waktu": stage(dimensions.time_dimension(dimensions.month_spine(bounds), known and known["dim_waktu"]), "dim-waktu"),
    }
    integrated = stage(integrate(monthly, annual, demography), "integrated")
    return {
        **dims,
        "ref_wilayah_master": wilayah,
        "ref_komoditas": dim_komoditas.select("id_komoditas", "nama_komoditas"),
        "tr_demografi": demography,
        "tr_statistik": annual,
        sinks.FACT: risk_fact(integrated, dims),
    }


def load_warehouse(tables: Mapping[str, DataFrame], folder: str) -> Tables:
    """Write the star as a new version, check what was written, and make it the current one.

    The fact lies in a folder for each month; filters on the months reach its scan. Only months
    whose rows differ from the current version's are written, once, and counted meanwhile; the
    others stay where an earlier load put them, and passed the counts then. Orphans and repeated
    keys are looked for in the whole fact. Months are told apart by checksums, so a change of the
    index bounds, which touches all months, writes all of them. The fact is read for the checksums
    and again for the write: pass a stored one.

    A load that breaks or fails a check changes nothing for readers; its folder goes at once, or
    with ``versions.drop_old`` if the driver was lost.
    """
    spark, load = tables[sinks.FACT].sparkSession, versions.new_load()
    before = versions.current(spark, folder)
    fact, by = star.align(tables[sinks.FACT]), star.FACT_LAYOUT
    new = {name: f"{load}/{name}" for name in (*star.DIMENSION_COLUMNS, sinks.FACT)}
    sums = sinks.checksums(fact, by)
    written, parts = versions.changed(before, sinks.FACT, sums, new[sinks.FACT])
    if len(written) < len(sums):
        fact = fact.where(versions.value_of(by).isin(written))
    version = versions.Version(0, new, {sinks.FACT: parts}, {sinks.FACT: sums}, {sinks.FACT: by})
    try:
        for name, columns in star.DIMENSION_COLUMNS.items():
            sinks.load_table(tables[name], f"{folder}/{load}", name, columns)
        counted = sinks.load_fact(fact, f"{folder}/{load}", sinks.FACT, by, quality.fact_counts(fact))
        loaded = _star_at(spark, folder, version)
        quality.require_clean(quality.warehouse_report(
            loaded[sinks.FACT], loaded["dim_prov"], loaded["dim_komoditas"], loaded["dim_waktu"], counted=counted
        ))
    except BaseException:
        versions.discard(spark, folder, load)
        raise
    versions.publish(spark, folder, version, before.number if before else 0)
    return loaded


def _star_at(spark: SparkSession, folder: str, version: versions.Version) -> Tables:
    """The tables of a star; the schema of the fact is given, as its layout holds one of its columns as text."""
    schema = ", ".join(f"{c} {t}" for c, t in star.FACT_TYPES.items())
    fact = versions.read_table(spark, folder, version, sinks.FACT, schema).select(*star.FACT_TYPES)
    return {**{n: versions.read_table(spark, folder, version, n) for n in star.DIMENSION_COLUMNS}, sinks.FACT: fact}


def read_warehouse(spark: SparkSession, folder: str, number: int | None = None) -> Tables:
    """The star as the current version has it, or the version with this number."""
    version = versions.current(spark, folder) if number is None else versions.read_version(spark, folder, number)
    if version is None:
        raise TableNotFound(f"no complete version of a warehouse at {folder}")
    return _star_at(spark, folder, version)


def cube_of(tables: Mapping[str, DataFrame], how: str = "inner") -> DataFrame:
    return star.cube(tables[sinks.FACT], tables["dim_prov"], tables["dim_komoditas"], tables["dim_waktu"], how)
