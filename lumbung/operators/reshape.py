"""Unions, keyed duplicates, pivots and unpivots."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name."""
    return reduce(DataFrame.unionByName, frames)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``.

    An aggregate, not a window: each task keeps one candidate per key before the shuffle. Spark
    plans it by sorting, inside the tasks and again after the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


def one_row_per_label(
    df: DataFrame, keep: Sequence[str], label: str, rows: Mapping[object, Mapping[str, Column]],
) -> DataFrame:
    """Turn one wide row into one row per label, reading the input once.

    ``rows`` maps each label value to the measures of its row; give a coalesce where a measure
    has several sources.
    """
    structs = [
        F.struct(F.lit(value).alias(label), *[c.alias(name) for name, c in measures.items()])
        for value, measures in rows.items()
    ]
    return df.select(*keep, F.inline(F.array(*structs)))


def commodity_rows(df: DataFrame, keep: Sequence[str] = ("id_wilayah", "tahun")) -> DataFrame:
    """The wide annual table as one row per commodity, substitutes filling missing values."""

    def first(*names: str) -> Column:
        return F.coalesce(*[F.col(n).cast("double") for n in names])

    return one_row_per_label(
        df, keep, "id_komoditas",
        {
            1: {
                "populasi": first("populasi_sapi", "populasi_sapi_dummy"),
                "produksi_daging": first("produksi_daging_sapi"),
                "konsumsi_daging": first("konsumsi_daging_sapi"),
                "permintaan_daging": first("permintaan_daging_sapi"),
                "jumlah_ternak_potong": first("jumlah_ternak_sapi_potong"),
                "harga_baseline": first("harga_baseline_sapi"),
            },
            2: {
                "populasi": first("populasi_ayam", "populasi_ayam_dummy"),
                "produksi_daging": first("produksi_daging_ayam", "produksi_daging_ayam_dummy"),
                "konsumsi_daging": first("konsumsi_daging_ayam"),
                "permintaan_daging": first("permintaan_daging_ayam"),
                "jumlah_ternak_potong": first("jumlah_ternak_ayam_potong"),
                "harga_baseline": first("harga_baseline_ayam"),
            },
        },
    )


def merge_indicators(
    df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str], how: Callable[[Column], Column] = F.max,
) -> DataFrame:
    """Long indicators to one wide row per key: what a chain of outer joins gives, in one grouping."""
    return df.groupBy(*keys).agg(*[how(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def heatmap(df: DataFrame, row: str, column: Column, value: str, columns: Sequence[str]) -> DataFrame:
    """Rows by periods, cells are means. The periods are given, so no extra job looks for them."""
    return df.withColumn("_period", column).groupBy(row).pivot("_period", list(columns)).agg(F.avg(value))


def longer(df: DataFrame, keep: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(keep), list(columns), name, value)
