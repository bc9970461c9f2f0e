"""Risk components, scaling and bands. Arguments are column names or SQL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumbung.sources.literals import sql_value

EPSILON = 1e-9
DASHBOARD_BANDS = ((0.6, "BAHAYA"), (0.3, "WASPADA"))
NOTEBOOK_BANDS = ((0.5, "BAHAYA"), (0.3, "WASPADA"))


def price_gap(price: str = "avg_harga", baseline: str = "harga_baseline") -> Column:
    """Relative distance of the price from its baseline; 0 where either is unusable."""
    return F.expr(
        f"CASE WHEN {baseline} > 0 AND {price} IS NOT NULL "
        f"THEN ({price} - {baseline}) / ({baseline} + {EPSILON}D) ELSE 0D END"
    )


def health_impact(
    sick: str = "sum_jumlah_sakit", dead: str = "sum_jumlah_mati", herd: str = "populasi_ternak",
) -> Column:
    """Sick and dead animals per animal kept; 0 without a herd size."""
    return F.expr(f"CASE WHEN {herd} > 0 THEN ({sick} + {dead}) / ({herd} + {EPSILON}D) ELSE 0D END")


def supply_strain(moved: str = "sum_vol_mutasi", demand: str = "avg_permintaan_bulanan") -> Column:
    """Animals moved per animal demanded; 0 without a demand."""
    return F.expr(f"CASE WHEN {demand} > 0 THEN {moved} / ({demand} + {EPSILON}D) ELSE 0D END")


def min_max(value: str, low: str, high: str) -> Column:
    """Scale to [0, 1]. A missing or zero maximum counts as 1; an empty range divides by 1."""
    low, high = f"coalesce({low}, 0D)", f"coalesce(nullif({high}, 0D), 1D)"
    scaled = f"({value} - {low}) / coalesce(nullif({high} - {low}, 0D), 1D)"
    return F.expr(f"CASE WHEN {value} IS NOT NULL THEN greatest(0D, least(1D, {scaled})) END")


def band(value: str, bands: Sequence[tuple[float, str]] = DASHBOARD_BANDS, rest: str = "AMAN") -> Column:
    """Label of the first lower bound that the value reaches; null gets ``rest``."""
    cases = " ".join(f"WHEN {value} >= {bound}D THEN {sql_value(label)}" for bound, label in bands)
    return F.expr(f"CASE {cases} ELSE {sql_value(rest)} END")


def above(value: str, bound: float = 0.3, label: str = "BAHAYA", rest: str = "AMAN") -> Column:
    """Two-way label with a strict bound."""
    return F.expr(f"CASE WHEN {value} > {bound}D THEN {sql_value(label)} ELSE {sql_value(rest)} END")
