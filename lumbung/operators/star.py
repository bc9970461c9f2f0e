"""Star schema: keys, alignment and the cube."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.sources.fixed_values import DIMENSION_COLUMNS, FACT_TYPES, RENAMES

FACT_KEYS = ["prov_key", "waktu_key", "komoditas_key"]
#: The loaded fact has a folder for each value of this column.
FACT_LAYOUT = "waktu_key"


def with_keys(df: DataFrame, dim_prov: DataFrame, dim_komoditas: DataFrame, dim_waktu: DataFrame) -> DataFrame:
    """Surrogate keys by region, commodity and month; rows without all three are dropped."""
    return (
        df.join(dim_prov.select("prov_key", F.col("id_prov").alias("id_wilayah")), "id_wilayah", "left")
        .join(dim_komoditas.select("komoditas_key", "id_komoditas"), "id_komoditas", "left")
        .join(dim_waktu.select("waktu_key", "tahun", "bulan"), ["tahun", "bulan"], "left")
        .dropna(subset=FACT_KEYS)
    )


def align(df: DataFrame, types: Mapping[str, str] = FACT_TYPES, renames: Mapping[str, str] = RENAMES) -> DataFrame:
    """Rename, add missing columns as typed nulls, and project in the given order."""
    old_name = {new: old for old, new in renames.items() if old in df.columns}
    present = set(df.columns)

    def source(c: str) -> str:
        return c if c in present else old_name.get(c, "NULL")

    return df.selectExpr(*[f"CAST({source(c)} AS {t}) AS {c}" for c, t in types.items()])


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def cube(
    fact: DataFrame, dim_prov: DataFrame, dim_komoditas: DataFrame, dim_waktu: DataFrame, how: str = "inner",
) -> DataFrame:
    """Fact rows with the attributes of their dimensions."""
    return (
        fact.join(dim_prov, "prov_key", how)
        .join(dim_waktu, "waktu_key", how)
        .join(dim_komoditas, "komoditas_key", how)
        .select(
            *fact.columns, "id_prov", "nama_provinsi", "tahun", "bulan", "kuartal", "nama_bulan",
            "id_komoditas", "nama_komoditas",
        )
    )
