"""Filling missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lumbung.operators.quantiles import exact_median, grouped_quantiles
from lumbung.session import stage


def fill_with_median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Null values of detail rows become the discrete median of their group.

    The rows are read three times: stage them first if they come from joins. The medians are
    staged: the planner then knows their size and broadcasts them when they are small, so that the
    detail rows are not shuffled and a hot group does no harm. Where only sums of the filled rows
    are wanted, ``sums_filled_with_median`` needs no such join.
    """
    medians = stage(exact_median(df, keys, F.col(value), "_median"), "group-medians")
    filled = df.join(medians, list(keys), "left")
    return filled.withColumn(value, F.coalesce(value, "_median")).drop("_median").select(*df.columns)


def sums_filled_with_median(df: DataFrame, keys: Sequence[str], more: Sequence[str], value: str) -> DataFrame:
    """_sum and _n of ``value`` per ``keys`` and ``more``, nulls taken as the discrete median of ``keys``.

    Detail rows are only summed: a null adds the median once. Nulls of a group without any value
    add nothing.
    """
    medians = exact_median(df, keys, F.col(value), "_median")
    small = df.groupBy(*keys, *more).agg(
        F.sum(value).alias("_known"), F.count(value).alias("_k"), F.count_if(F.col(value).isNull()).alias("_missing")
    )
    added = F.when(F.col("_median").isNotNull(), F.col("_missing")).otherwise(0)
    filled = small.join(medians, list(keys), "left").withColumns(
        {"_sum": F.coalesce("_known", F.lit(0.0)) + F.coalesce(added * F.col("_median"), F.lit(0.0)), "_n": F.col("_k") + added}
    )
    return filled.select(*keys, *more, "_sum", "_n")


def fill_with_mean(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Null values of a statistics table become the mean of their group.

    A group is one region and commodity with a row per year, so a window holds only those years.
    """
    group = W.partitionBy(*keys)
    return df.withColumns({v: F.coalesce(F.col(v), F.avg(v).over(group)) for v in values})


def last_known(value: str, keys: Sequence[str], order: Sequence[str]) -> Column:
    """The latest earlier non-null value of the group (one row per month and group)."""
    earlier = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.last(value, ignorenulls=True).over(earlier)


def fill_price_gaps(
    df: DataFrame, value: str = "avg_harga", region: str = "id_wilayah", commodity: str = "id_komoditas",
) -> DataFrame:
    """Own price, else the latest earlier one, else the median of the commodity.

    For monthly rows, one per region and commodity. The input is read twice: stage it.
    """
    medians = grouped_quantiles(df, [commodity], value, {"_median": 0.5})
    earlier = last_known(value, [region, commodity], ["tahun", "bulan"])
    filled = df.withColumn("_earlier", earlier).join(medians, commodity, "left")
    return filled.withColumn(value, F.coalesce(value, "_earlier", "_median")).select(*df.columns)


def null_audit(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls_before, nulls_after), each side counted in one pass."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return row.unpivot([], list(columns), "column_name", name)

    return counts(before, "nulls_before").join(counts(after, "nulls_after"), "column_name")
