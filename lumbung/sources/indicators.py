"""Annual indicators delivered as JSON documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions import text
from lumbung.operators.reshape import merge_indicators
from lumbung.sources.fixed_values import INDICATORS

# A payload's "data" array holds a page header first and the table second. Both are read with one
# element type; the header leaves the fields empty.
PAYLOAD_SCHEMA = (
    "status string, data array<struct<"
    "kolom: map<string, struct<nama_variabel: string>>,"
    "data: array<struct<label: string, kode_wilayah: string, variables: map<string, struct<value_raw: string>>>>>>"
)


def variable_id(table: Column, words: Sequence[str]) -> Column:
    """Key of the first variable whose label holds every word; null if there is none."""
    hits = F.filter(
        F.map_entries(table["kolom"]), lambda e: text.contains_all(e["value"]["nama_variabel"], words)
    )
    return F.get(hits, F.lit(0))["key"]


def with_indicator(df: DataFrame, payload: str, words: Sequence[str]) -> DataFrame:
    """Add the parsed table and the id of the wanted variable; unusable payloads drop out."""
    parsed = F.from_json(F.col(payload), PAYLOAD_SCHEMA)
    return (
        df.withColumn("_doc", parsed)
        .withColumn("_table", F.get(F.col("_doc.data"), F.lit(1)))
        .withColumn("_variable", variable_id(F.col("_table"), words))
        .where((F.col("_doc.status") == "OK") & F.col("_variable").isNotNull())
    )


def parse_indicator(df: DataFrame, words: Sequence[str], column: str, payload: str = "payload") -> DataFrame:
    """(provinsi, tahun, column) from payloads with their year; values stay raw text."""
    rows = with_indicator(df, payload, words).select("tahun", "_variable", F.explode("_table.data").alias("r"))
    return rows.where(text.is_real_region(F.col("r.label"), F.col("r.kode_wilayah"))).select(
        F.trim("r.label").alias("provinsi"),
        "tahun",
        F.col("r.variables")[F.col("_variable")]["value_raw"].alias(column),
    )


def parse_region_indicator(df: DataFrame, words: Sequence[str], column: str, payload: str = "payload") -> DataFrame:
    """Per-region payloads: keep the row that carries the region's own name (its total).

    Input columns: provinsi, tahun and the payload. Adds the region code.
    """
    rows = with_indicator(df, payload, words).select(
        "provinsi", "tahun", "_variable",
        F.get(
            F.filter("_table.data", lambda r: F.lower(r["label"]) == F.lower(F.col("provinsi"))), F.lit(0)
        ).alias("r"),
    )
    return rows.where(F.col("r").isNotNull()).select(
        "tahun", "provinsi", F.col("r.kode_wilayah").alias("kode_wilayah"),
        F.col("r.variables")[F.col("_variable")]["value_raw"].alias(column),
    )


def first_valid(df: DataFrame, keys: Sequence[str], priority: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """Per key the values of the row that comes first by ``priority``.

    ``min_by`` combines inside each task (by sorting its rows), so a key with very many candidates
    sends one row per task.
    """
    best = F.min_by(F.struct(*values), F.struct(*priority)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def first_valid_payload(df: DataFrame, words: Sequence[str], payload: str = "payload") -> DataFrame:
    """Per year the usable payload with the lowest ``urutan`` (source order)."""
    usable = with_indicator(df, payload, words)
    return first_valid(usable, ["tahun"], [F.col("urutan")], [payload])


def indicator_values(payloads: DataFrame, indicators: Mapping[str, Sequence[str]], payload: str = "payload") -> DataFrame:
    """(indikator, tahun, urutan, _values) of the usable documents, each parsed once for whatever it is wanted for.

    _values has label, kode_wilayah and nilai (raw text) of every row of the document's table, taken
    from the first variable whose label holds all words of the indicator. The parsed document goes
    through ``inline``, so that no filter on its parts makes Spark parse it again.
    """
    words = F.create_map(*[x for c, w in indicators.items() for x in (F.lit(c), F.array(*[F.lit(v.lower()) for v in w]))])
    parsed = payloads.where(F.col("indikator").isin(*indicators)).select(
        "indikator", "tahun", "urutan", F.element_at(words, F.col("indikator")).alias("_words"),
        F.inline(F.array(F.from_json(F.col(payload), PAYLOAD_SCHEMA))),
    )
    table = F.get("data", F.lit(1))
    label = lambda e: F.coalesce(F.lower(e["value"]["nama_variabel"]), F.lit(""))
    hits = F.filter(F.map_entries(table["kolom"]), lambda e: F.forall("_words", lambda w: label(e).contains(w)))
    picked = parsed.where("status = 'OK'").select(
        "indikator", "tahun", "urutan", table["data"].alias("_rows"), F.get(hits, F.lit(0))["key"].alias("_variable")
    )
    values = F.transform("_rows", lambda r: F.struct(
        r["label"].alias("label"), r["kode_wilayah"].alias("kode_wilayah"), r["variables"][F.col("_variable")]["value_raw"].alias("nilai")
    ))
    return picked.where("_variable IS NOT NULL").select("indikator", "tahun", "urutan", values.alias("_values"))


def annual_statistics(payloads: DataFrame, indicators: Mapping[str, Sequence[str]] = INDICATORS) -> DataFrame:
    """One row per region and year with every indicator, from (indikator, tahun, urutan, payload).

    Each indicator and year takes its first usable payload. The documents are read and parsed once
    for all indicators, and the merge is one grouping of all values.
    """
    chosen = first_valid(indicator_values(payloads, indicators), ["indikator", "tahun"], [F.col("urutan")], ["_values"])
    rows = chosen.select("indikator", "tahun", F.inline("_values"))
    rows = rows.where(text.is_real_region(F.col("label"), F.col("kode_wilayah"))).select(
        F.trim("label").alias("provinsi"), "tahun", "indikator", "nilai"
    )
    return merge_indicators(rows, ["provinsi", "tahun"], "indikator", "nilai", list(indicators))
