"""Number parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_number(c: Column) -> Column:
    """``1.234,56`` (dot thousands, comma decimals) to double; unreadable text gives null."""
    return F.translate(c.cast("string"), ",.", ".").try_cast("double")


def stable_round(c: Column | str, digits: int) -> Column:
    """Half-up rounding, of a column or a SQL expression, that ignores summation-order noise.

    Sums of doubles depend on the order in which partitions arrive. Rounding to six spare digits
    first makes a tie such as x.xx5 round the same way on every run and partitioning.
    """
    if isinstance(c, str):
        return F.expr(f"round(round({c}, {digits + 6}), {digits})")
    return F.round(F.round(c, digits + 6), digits)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero denominator, also under ANSI mode."""
    return F.try_divide(numerator, denominator)
