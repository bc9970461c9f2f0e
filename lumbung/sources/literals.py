"""Small tables written in the program."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def sql_value(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[object]]) -> DataFrame:
    """Rows as SQL values: the planner knows their size and broadcasts them in joins."""
    body = ", ".join("(" + ", ".join(map(sql_value, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def alias_table(spark: SparkSession, aliases: Mapping[str, str]) -> DataFrame:
    return literal_table(spark, ["alias", "canonical"], list(aliases.items()))
