"""The composite supply-risk index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import risk
from lumbung.functions.numeric import stable_round

COMPONENTS = ("price_gap", "health_impact", "supply_strain")


def with_components(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "raw_price_gap": risk.price_gap(),
            "raw_health_impact": risk.health_impact(),
            "raw_supply_strain": risk.supply_strain(),
        }
    )


def min_max_scaled(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Scale each column over all rows; ``columns`` maps input to output name.

    All bounds come from one aggregate, used as a scalar subquery: it runs as part of the same
    job and nothing is collected.
    """
    bounds = ", ".join(f"'min_{c}', min({c}), 'max_{c}', max({c})" for c in columns)
    row = df.agg(F.expr(f"named_struct({bounds})")).scalar()
    scaled = {out: risk.min_max(c, f"_bounds.min_{c}", f"_bounds.max_{c}") for c, out in columns.items()}
    return df.withColumn("_bounds", row).withColumns(scaled).drop("_bounds")


def with_index(df: DataFrame, components: Sequence[str] = COMPONENTS) -> DataFrame:
    """Mean of the scaled components, six decimals."""
    scaled = min_max_scaled(df, {f"raw_{c}": f"scaled_{c}" for c in components})
    total = " + ".join(f"scaled_{c}" for c in components)
    return scaled.withColumn("supply_risk_index", stable_round(f"({total}) / {len(components)}D", 6))
