"""Readers for staging tables, Parquet outputs, the cube CSV and price sheets."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.functions import dates, text
from lumbung.sources import versions
from lumbung.sources.fixed_values import ATTRIBUTE_TYPES, FACT_TYPES, MEAT_WORDS


class TableNotFound(FileNotFoundError):
    """Neither ``<folder>/<name>`` nor ``<folder>/<name>.parquet`` can be read."""


def read_staging(spark: SparkSession, folder: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """One staging table, whole; with ``schema`` the files are not probed for one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{table}.parquet")


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str, bounds: tuple[int, int],
    partitions: int, **options: str,
) -> DataFrame:
    """A database table read by many tasks, each with its own range of ``partition_column``.

    Rows outside the bounds are read too: Spark gives them to the first and the last task.
    """
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=partitions, properties=options,
    )


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet folder, else a single file, with lower-case column names.

    In a folder of versioned tables it is the one of the current version.
    """
    version = versions.current(spark, folder)
    if version and name in version.tables:
        df = versions.read_table(spark, folder, version, name)
        return df.toDF(*[c.lower() for c in df.columns])
    for path in (f"{folder}/{name}", f"{folder}/{name}.parquet"):
        try:
            df = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            return df.toDF(*[c.lower() for c in df.columns])
    raise TableNotFound(f"no Parquet data at {folder}/{name} or {folder}/{name}.parquet")


def sql_query(spark: SparkSession, statement: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """A SQL statement over DataFrames; ``{name}`` in it stands for a table of that name."""
    return spark.sql(statement, **tables)


# The cube's columns as they are exported, in order.
CUBE_SCHEMA = ", ".join(f"{c} {t}" for c, t in (FACT_TYPES | ATTRIBUTE_TYPES).items())


def read_cube_csv(spark: SparkSession, path: str) -> DataFrame:
    """The exported cube, typed, with upper-case region names."""
    df = spark.read.schema(CUBE_SCHEMA).csv(path, header=True, encoding="UTF-8")
    return df.withColumn("nama_provinsi", text.upper_key(F.col("nama_provinsi")))


DATE_HEADER = re.compile(r"\d{1,2}[/\-]\s*\d{1,2}[/\-]\s*\d{4}")


def unpivot_price_sheet(
    df: DataFrame, region: Column, market: Column, city: Column, words: Sequence[str] = MEAT_WORDS,
) -> DataFrame:
    """A wide price sheet (one column per day) as one row per label and day.

    The label column is the first whose name holds "komoditas", else the second column. Without
    ``words`` all labelled rows are kept, except a repeated header. Spark unpivots inside each
    task, so a sheet needs no shuffle.
    """
    named = [c for c in df.columns if "komoditas" in c.lower()]
    label = named[0] if named else df.columns[1]
    days = [c for c in df.columns if DATE_HEADER.search(c)]
    if not days:
        raise ValueError("no column name in the sheet is a date")
    wide = df.select(
        F.trim(F.col(f"`{label}`").cast("string")).alias("jenis_daging"),
        *[F.col(f"`{c}`").cast("string").alias(c) for c in days],
        region.alias("provinsi"), city.alias("kota"), market.alias("jenis_pasar"),
    )
    name = F.col("jenis_daging")
    wide = wide.where(text.contains_any(name, words) if words else (F.lower(name) != "komoditas (rp)"))
    long = wide.unpivot(
        ["jenis_daging", "provinsi", "kota", "jenis_pasar"], [f"`{c}`" for c in days], "waktu_raw", "harga"
    )
    return _typed_prices(long)


def _typed_prices(long: DataFrame) -> DataFrame:
    """Prices and the days of their headers, typed; unreadable ones become null."""
    return long.select(
        "provinsi", "kota", "jenis_daging", "jenis_pasar",
        F.col("harga").try_cast("double").alias("harga"),
        dates.header_date(F.regexp_replace("waktu_raw", "-", "/")).cast("timestamp_ntz").alias("waktu"),
    )


def read_price_sheets(spark: SparkSession, paths: str | Sequence[str], words: Sequence[str] = MEAT_WORDS) -> DataFrame:
    """Price sheets as CSV below ``<region>/.../<MARKET>_<CITY>.csv``, all in one read.

    All files of one call must share their header; ``read_mixed_price_sheets`` takes any.
    """
    df = spark.read.csv(paths, header=True, recursiveFileLookup=True, enforceSchema=False)
    # The path comes URL-encoded, but with a plain "+".
    df = df.withColumn("_file", F.expr("url_decode(replace(_metadata.file_path, '+', '%2B'))"))
    market, city = text.split_label(text.file_label(F.col("_file")))
    region = F.upper(F.trim(F.element_at(F.split("_file", "/"), -2)))
    return unpivot_price_sheet(df, region, market, city, words)


def csv_cells(line: Column) -> Column:
    """The cells of a CSV line; quoted ones without their quotes, empty ones as null."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]++|"")*+"|[^,]*)'), F.lit(1))

    def plain(c: Column) -> Column:
        quoted = c.startswith('"') & c.endswith('"') & (F.length(c) > 1)
        inside = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(quoted, inside).otherwise(c), F.lit(""))

    return F.transform(cells, plain)


def read_mixed_price_sheets(
    spark: SparkSession, paths: str | Sequence[str], words: Sequence[str] = MEAT_WORDS,
) -> DataFrame:
    """Price sheets as CSV below ``<region>/.../<MARKET>_<CITY>.csv``, each with its own days, all in one read.

    A sheet is one row of the scan: its first line names the columns of its other lines. The label
    column is the first whose name holds "komoditas", else the second; columns whose name is no
    date are left out, and so are sheets without any. Line breaks inside quotes end a line. Sheets
    must fit into memory one by one, not together; nothing is shuffled.
    """
    files = spark.read.text(paths, wholetext=True, recursiveFileLookup=True)
    path = F.expr("url_decode(replace(_metadata.file_path, '+', '%2B'))")
    lines = F.filter(F.split(F.regexp_replace("value", "^\uFEFF", ""), r"\r?\n"), lambda x: F.trim(x) != "")
    sheets = files.select(path.alias("_file"), lines.alias("_lines")).where(F.size("_lines") > 1)
    market, city = text.split_label(text.file_label(F.col("_file")))
    sheets = sheets.select(
        F.upper(F.trim(F.element_at(F.split("_file", "/"), -2))).alias("provinsi"), city.alias("kota"), market.alias("jenis_pasar"),
        csv_cells(F.get("_lines", F.lit(0))).alias("_names"), F.slice("_lines", F.lit(2), F.size("_lines")).alias("_lines"),
    )
    places = F.sequence(F.lit(0), F.size("_names") - 1)
    name_at = lambda i: F.coalesce(F.get("_names", i), F.lit(""))
    labels = F.filter(places, lambda i: F.lower(name_at(i)).contains("komoditas"))
    days = F.filter(places, lambda i: name_at(i).rlike(DATE_HEADER.pattern))
    sheets = sheets.select("*", F.coalesce(F.get(labels, F.lit(0)), F.lit(1)).alias("_label"), days.alias("_days"))
    rows = sheets.where(F.size("_days") > 0).select(
        "provinsi", "kota", "jenis_pasar", "_names", "_label", "_days", F.explode("_lines").alias("_line")
    )
    rows = rows.withColumn("_cells", csv_cells(F.col("_line")))
    rows = rows.withColumn("jenis_daging", F.trim(F.get("_cells", F.col("_label"))))
    name = F.col("jenis_daging")
    rows = rows.where(text.contains_any(name, words) if words else (F.lower(name) != "komoditas (rp)"))
    values = F.transform("_days", lambda i: F.struct(F.get("_names", i).alias("waktu_raw"), F.get("_cells", i).alias("harga")))
    return _typed_prices(rows.select("jenis_daging", "provinsi", "kota", "jenis_pasar", F.inline(values)))


PRICE_COLUMNS = ("provinsi", "kota", "jenis_daging", "jenis_pasar", "harga", "waktu")


def union_files(frames: Iterable[DataFrame], columns: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """Stack price frames in a fixed column order; unreadable prices and times become null."""
    out = None
    for df in frames:
        part = df.select(
            *[F.col(c).cast("string") for c in columns if c not in ("harga", "waktu")],
            F.col("harga").cast("string").try_cast("double").alias("harga"),
            F.col("waktu").cast("string").try_cast("timestamp_ntz").alias("waktu"),
        ).select(*columns)
        out = part if out is None else out.unionByName(part)
    return out
