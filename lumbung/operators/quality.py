"""Data-quality checks. Each gives rows (check_name, table_name, column_name, bad_rows)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.reshape import stack
from lumbung.session import stage

REPORT = "check_name string, table_name string, column_name string, bad_rows bigint"


class QualityError(ValueError):
    """A gate found bad rows; the message lists the failed checks."""


def _row(check: str, table: str, column: str, bad: Column) -> list[Column]:
    return [
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"), bad.cast("bigint").alias("bad_rows"),
    ]


def required_columns(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A missing column makes every row of the table bad; only then is the table read."""
    one = df.sparkSession.range(1)
    rows = df.agg(F.count(F.lit(1)).alias("n"))
    return stack([
        one.select(*_row("required_column", table, c, F.lit(0))) if c in df.columns
        else rows.select(*_row("required_column", table, c, F.col("n")))
        for c in columns
    ])


def null_counts(table: str, df: DataFrame, columns: Sequence[str] | None = None, check: str = "null") -> DataFrame:
    """Nulls of every column, counted in one pass over the table."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], columns, "column_name", "bad_rows")
    return long.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "column_name", "bad_rows")


def orphan_keys(table: str, df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Distinct key values without a dimension row.

    Keys are made distinct first (partly inside each task), so that a key that fills a third of
    the table reaches the join once.
    """
    keys = df.select(F.col(column).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    lost = keys.join(dim.select(F.col(key).alias("_k")), "_k", "left_anti")
    return lost.agg(F.count(F.lit(1)).alias("n")).select(*_row("orphan_key", table, column, F.col("n")))


def orphan_rows(table: str, df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows without a dimension row, null keys included.

    Rows are counted per key first; only keys and counts are joined.
    """
    counted = df.groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    lost = counted.join(dim.select(F.col(key).alias("_k")), "_k", "left_anti")
    bad = lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    return bad.select(*_row("orphan_row", table, column, F.col("n")))


def repeated_keys(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return twice.agg(F.count(F.lit(1)).alias("n")).select(*_row("unique", table, ",".join(keys), F.col("n")))


def repeated_names(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def wrong_types(table: str, df: DataFrame, types: Mapping[str, str], required: Sequence[str] = ()) -> DataFrame:
    """Values that do not fit the declared type, and nulls in required columns."""
    types, required = dict(types), set(required)

    def bad(c: str) -> Column:
        value = F.col(c)
        unfit = value.isNotNull() & value.try_cast(types[c]).isNull()
        return F.count_if(unfit | value.isNull()) if c in required else F.count_if(unfit)

    present = [c for c in types if c in df.columns]
    counts = df.agg(*[bad(c).alias(c) for c in present])
    long = counts.unpivot([], present, "column_name", "bad_rows")
    return long.select(F.lit("type").alias("check_name"), F.lit(table).alias("table_name"), "column_name", "bad_rows")


#: Keys of the fact with the dimension of each, and the columns that must be there.
FACT_KEYS = {"prov_key": "dim_prov", "waktu_key": "dim_waktu", "komoditas_key": "dim_komoditas"}
NAMES = {"dim_prov": ["prov_key", "nama_provinsi"], "dim_komoditas": ["komoditas_key", "nama_komoditas"],
         "dim_waktu": ["waktu_key", "tahun", "bulan"]}


def fact_counts(fact: DataFrame) -> dict[str, Column]:
    """What the report needs of the rows of a fact table one by one: their number, and the nulls of each key."""
    nulls = {f"null_{k}": F.count_if(F.col(k).isNull()) for k in FACT_KEYS if k in fact.columns}
    return {"rows": F.count(F.lit(1)), **nulls}


def _fixed(spark: SparkSession, rows: Sequence[tuple[str, str, str, int]]) -> DataFrame:
    parts = [spark.range(1).select(*_row(check, table, column, F.lit(bad))) for check, table, column, bad in rows]
    return stack(parts)


def warehouse_report(
    fact: DataFrame, dim_prov: DataFrame, dim_komoditas: DataFrame, dim_waktu: DataFrame,
    fact_name: str = "fact_supply_resilience", counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """All checks that must pass before a load.

    ``counted`` has the ``fact_counts`` if they were taken while the fact was written. Else they
    are taken here, in one pass. Orphans and repeated keys come from the combinations of keys,
    which are counted in one more pass and staged: three integers for each.
    """
    spark = fact.sparkSession
    dims = {"dim_prov": dim_prov, "dim_komoditas": dim_komoditas, "dim_waktu": dim_waktu}
    parts = [required_columns(name, dims[name], NAMES[name]) for name in dims]
    present = [k for k in FACT_KEYS if k in fact.columns]
    counted = fact.agg(*[c.alias(n) for n, c in fact_counts(fact).items()]).first().asDict() if counted is None else counted
    wanted = [*FACT_KEYS, "supply_risk_index"]
    parts.append(_fixed(spark, [("required_column", fact_name, c, 0 if c in fact.columns else counted["rows"]) for c in wanted]))
    if present:
        parts.append(_fixed(spark, [("null_key", fact_name, k, counted[f"null_{k}"]) for k in present]))
        keys = stage(fact.groupBy(*present).agg(F.count(F.lit(1)).alias("n")), "fact-keys")
        parts += [orphan_keys(fact_name, keys, k, dims[FACT_KEYS[k]], k) for k in present if k in dims[FACT_KEYS[k]].columns]
        if len(present) == len(FACT_KEYS):
            twice = keys.where("n > 1").agg(F.count(F.lit(1)).alias("n"))
            parts.append(twice.select(*_row("unique", fact_name, ",".join(present), F.col("n"))))
    return stack(parts)


def require_clean(report: DataFrame) -> None:
    """Raise if a check found bad rows. Collects only the report, one row per check."""
    failed = report.where(F.col("bad_rows") > 0).collect()
    if failed:
        lines = [f"{r.check_name} {r.table_name}.{r.column_name}: {r.bad_rows}" for r in failed]
        raise QualityError("; ".join(sorted(lines)))
