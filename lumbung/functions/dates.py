"""Date parsing, calendar parts and period labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.sources.fixed_values import MONTH_NAMES


def event_date(c: Column) -> Column:
    """Month/day/year with two or four digits of the year, padded or not; anything else gives null.

    The length of the last part decides which format is tried, because a failed parse costs far
    more than a good one.
    """
    text = F.trim(c)
    month, day = F.instr(text, "/"), F.length(F.substring_index(text, "/", 2))
    padded = month.between(2, 3) & (day - month).between(1, 2)
    year = F.length(text) - day
    return F.when(padded & (year == 3), F.try_to_date(text, "M/d/yy")).when(padded & (year == 5), F.try_to_date(text, "M/d/yyyy"))


def header_date(c: Column) -> Column:
    """Day-first column header such as ``02/ 01/ 2024``, blanks ignored."""
    return F.try_to_date(F.regexp_replace(c, r"\s+", ""), "d/M/yyyy")


def with_event_date(df: DataFrame, column: str, prefix: str | None = None) -> DataFrame:
    """Parse ``column`` in place and add its month and year as integers."""
    prefix = prefix or column
    return df.withColumn(column, event_date(F.col(column))).withColumns(
        {f"{prefix}_bulan": F.month(column), f"{prefix}_tahun": F.year(column)}
    )


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def period_slash(year: Column, month: Column) -> Column:
    return F.format_string("%d/%02d", year, month)


def period_dash(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)


def period_quarter(year: Column, quarter: Column) -> Column:
    return F.format_string("%d Q%d", year, quarter)


def period_number(year: Column, month: Column) -> Column:
    return (year * 100 + month).cast("int")


def quarter_of(month: Column) -> Column:
    return F.ceil(month / F.lit(3)).cast("int")


def month_name(month: Column) -> Column:
    """Indonesian month name; null outside 1..12."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.when(month.between(1, 12), F.get(names, month - 1))
