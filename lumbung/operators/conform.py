"""Joins that bring sources onto common names and keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions import text
from lumbung.operators.cleaning import canonical_names
from lumbung.sources.fixed_values import STATISTICS_COLUMNS


def merge_sources(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Inner join on shared keys, then the wanted columns under their new names."""
    joined = left.join(right, list(keys), "inner")
    return joined.select(*keys, *[c.alias(name) for name, c in columns.items()])


def merge_statistics(api: DataFrame, substitute: DataFrame) -> DataFrame:
    """Annual statistics of both sources, for the region-years that both have."""
    sub = substitute.select("provinsi", "tahun", *[c for c in substitute.columns if c.endswith("_dummy")])
    return merge_sources(
        api, sub, ["provinsi", "tahun"], {new: F.col(old) for new, old in STATISTICS_COLUMNS.items()}
    )


def replace_name_by_id(df: DataFrame, regions: DataFrame, name: str = "provinsi") -> DataFrame:
    """Region id instead of region name; an unknown name gives a null id."""
    return df.join(regions, name, "left").drop(name)


def reconcile_regions(left: DataFrame, right: DataFrame, on: Column | None = None) -> DataFrame:
    """All regions of two (id_wilayah, provinsi) lists; the left side wins.

    The lists are matched by canonical name. Matching by id is only right when both lists number
    the regions alike: pass ``on`` with the columns as ``l.*`` and ``r.*`` for that.
    """
    if on is None:
        on = text.lower_key(F.col("l.provinsi")) == text.lower_key(F.col("r.provinsi"))
    return left.alias("l").join(right.alias("r"), on, "full").select(
        F.coalesce("l.id_wilayah", "r.id_wilayah").alias("id_wilayah"),
        F.coalesce("l.provinsi", "r.provinsi").alias("provinsi"),
    )


def lookup(events: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join to a lookup table on a shared key column."""
    return events.join(table, key, "left")


def join_by_name(df: DataFrame, dim: DataFrame, name: str, dim_name: str, how: str = "left") -> DataFrame:
    """Join on names, ignoring case and outer blanks.

    Both sides get the cleaned name as an ordinary key column, so it stays an equi-join.
    """
    left = df.withColumn("_name_key", text.lower_key(F.col(name)))
    right = dim.withColumn("_name_key", text.lower_key(F.col(dim_name)))
    return left.join(right, "_name_key", how).drop("_name_key")


def unmatched_names(df: DataFrame, dim: DataFrame, name: str, dim_name: str) -> DataFrame:
    """Distinct names that no dimension row has.

    Names are reduced to distinct ones before the anti join, so that only names are shuffled.
    """
    names = df.select(F.col(name).alias("_unmatched")).distinct()
    left = names.withColumn("_name_key", text.lower_key(F.col("_unmatched")))
    right = dim.select(text.lower_key(F.col(dim_name)).alias("_name_key"))
    return left.join(right, "_name_key", "left_anti").select(F.col("_unmatched").alias(name))


def map_join(shapes: DataFrame, metrics: DataFrame, aliases: Mapping[str, str], shape_name: str = "provinsi") -> DataFrame:
    """Every boundary with the metrics of its region; regions without data stay.

    Boundary and region names go through the same alias table.
    """

    def keyed(df: DataFrame, name: str) -> DataFrame:
        named = canonical_names(df.withColumn("_key", F.col(name)), "_key", aliases)
        return named.withColumn("_key", text.upper_key(F.col("_key")))

    return keyed(shapes, shape_name).join(keyed(metrics, "nama_provinsi"), "_key", "left").drop("_key")


def centre_join(centres: DataFrame, metrics: DataFrame) -> DataFrame:
    """Regions with a place and a risk, and the radius of their bubble."""
    left = centres.withColumn("nama_provinsi", F.upper("nama_provinsi"))
    right = metrics.withColumn("nama_provinsi", F.upper("nama_provinsi"))
    joined = left.join(right, "nama_provinsi", "left").where(F.col("supply_risk_index").isNotNull())
    radius = F.greatest(F.lit(6.0), F.least(F.lit(30.0), F.col("supply_risk_index") * 40))
    return joined.withColumn("radius", radius)


def without_centre(centres: DataFrame, metrics: DataFrame) -> DataFrame:
    """(nama_provinsi): regions with a risk that ``centre_join`` can't place, as no centre has their name."""
    named = metrics.where(F.col("supply_risk_index").isNotNull()).select(F.upper("nama_provinsi").alias("nama_provinsi"))
    return named.distinct().join(centres.select(F.upper("nama_provinsi").alias("nama_provinsi")), "nama_provinsi", "left_anti")
