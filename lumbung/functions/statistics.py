"""Pearson correlation and its two-sided significance as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Aggregate expression for Pearson's r; null when either side is constant."""
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of Pearson's r over n pairs (Student's t with n - 2 degrees of freedom).

    For an integer number of degrees of freedom v the probability of |T| <= t is a finite series
    (Abramowitz and Stegun 26.7.3 and 26.7.4) in sin(a) = |r| and cos(a)^2 = 1 - r^2.
    Null below one degree of freedom, 0 for |r| = 1.
    """
    v = (n - 2).cast("int")
    sine = F.abs(r)
    cos2 = F.lit(1.0) - r * r
    odd = v % 2 == 1
    first = F.when(odd, F.sqrt(F.greatest(cos2, F.lit(0.0)))).otherwise(F.lit(1.0))
    terms = F.when(odd, F.floor((v - 1) / 2)).otherwise(F.floor(v / 2)).cast("int")
    # Each further term is the one before times cos^2 and (2k-1)/(2k), or 2k/(2k+1) when v is odd.
    steps = F.when(terms >= 2, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>"))

    def add(acc: Column, k: Column) -> Column:
        factor = F.when(odd, (k * 2) / (k * 2 + 1.0)).otherwise((k * 2 - 1.0) / (k * 2))
        term = acc["term"] * factor * cos2
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    start = F.when(terms >= 1, first).otherwise(F.lit(0.0))
    total = F.aggregate(steps, F.struct(start.alias("term"), start.alias("total")), add, lambda a: a["total"])
    inside = F.when(odd, F.lit(2.0) / F.pi() * (F.asin(F.least(sine, F.lit(1.0))) + sine * total)).otherwise(sine * total)
    p = F.greatest(F.lit(0.0), F.lit(1.0) - inside)
    return F.when(r.isNull() | (v < 1), F.lit(None).cast("double")).when(cos2 <= 0, F.lit(0.0)).otherwise(p)


def strength(r: Column) -> Column:
    """Plain-word size of a correlation."""
    size = F.abs(r)
    return F.when(size >= 0.7, F.lit("kuat")).when(size >= 0.5, F.lit("sedang")).otherwise(F.lit("lemah"))


def verdict(r: Column, p: Column, alpha: float = 0.05) -> Column:
    """Significant rise, significant fall, or neither."""
    return (
        F.when((p < alpha) & (r > 0), F.lit("signifikan positif"))
        .when((p < alpha) & (r < 0), F.lit("signifikan negatif"))
        .otherwise(F.lit("tidak signifikan"))
    )
