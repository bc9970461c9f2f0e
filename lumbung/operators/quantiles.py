"""Exact quantiles per group, for small groups and for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.session import stage

#: Cells of an octave in the first histogram: a cell is about one per cent wide.
FINE = 64
CELLS = 1_000


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float], method: str = "disc",
) -> DataFrame:
    """Quantiles of monthly rows by Spark's own aggregates.

    These keep the distinct values of a group in one task. That is right for the fact table and
    the cube, whose groups hold at most regions times months; use ``exact_quantiles`` for detail.
    """
    picks = [
        F.expr(f"percentile_{method}({p}D) WITHIN GROUP (ORDER BY {value}) AS {name}") for name, p in quantiles.items()
    ]
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(*picks)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: Column, quantiles: Mapping[str, float], method: str = "disc",
) -> DataFrame:
    """One row per group with the named exact quantiles of the non-null values of detail rows.

    ``disc`` takes the first value whose cumulative share reaches the quantile, ``cont``
    interpolates between neighbours. The input is read twice.

    1. Rows are counted by the cell of their value: its sign and the leading binary digits of its
       size, so that cells come in the order of values. Running sums tell the cell of each wanted
       rank; its least and largest value bracket the quantile.
    2. Values outside the brackets are only counted, inside each task; values within are counted
       per value, hashed by group and value. This is staged.
    3. Finer cells of a bracket are ranked by their counts, which finds the cell of each wanted rank.
    4. Only the values of those cells are ranked one by one.

    All groupings are hash aggregates, the same for groups of any size. No task holds a whole group:
    a window sees the cells of one, some thousand at most, or the values of one fine cell.
    """
    keys, quantiles = list(keys), dict(sorted(quantiles.items(), key=lambda item: item[1]))
    rows = df.select(*keys, value.cast("double").alias("_v")).where("_v IS NOT NULL")
    joined = _with_brackets(rows, keys, list(quantiles.values()), method)

    # Place of a value: the first bracket that holds it, else behind the last that ends below it.
    n = range(len(quantiles))
    held = " ".join(f"WHEN _v BETWEEN _lo{i} AND _hi{i} THEN {i}" for i in n)
    behind = " ".join(f"WHEN _hi{i} < _v THEN {i}" for i in reversed(n))
    cell = " ".join(
        f"WHEN {i} THEN CAST(coalesce(floor(try_divide(_v - _lo{i}, _hi{i} - _lo{i}) * {CELLS}), 0) AS int)" for i in n
    )
    counted = joined.withColumn("_held", F.expr(f"CASE {held} END")).selectExpr(
        *keys,
        f"coalesce(_held, CASE {behind} ELSE -1 END) AS _place",
        f"CASE _held {cell} ELSE {CELLS + 1} END AS _cell",
        "_held IS NULL AS _gap",
        "if(_held IS NULL, NULL, _v) AS _m",
    )
    counted = counted.groupBy(*keys, "_place", "_cell", "_gap", "_m").agg(F.expr("count(*) AS _c"))
    counted = stage(counted, "quantile-counts")

    group = f"PARTITION BY {', '.join(keys)} " if keys else ""
    cells = counted.groupBy(*keys, "_place", "_cell").agg(F.expr("sum(_c) AS _c")).selectExpr(
        "*", f"sum(_c) OVER ({group}) AS _n", f"sum(_c) OVER ({group}ORDER BY _place, _cell ROWS UNBOUNDED PRECEDING) AS _upto"
    )
    ranks = sorted({r for p in quantiles.values() for r in _ranks(p, method)})
    wanted = " OR ".join(f"({r} > _upto - _c AND {r} <= _upto)" for r in ranks)
    cells = cells.where(wanted).selectExpr(*keys, "_place", "_cell", "_n", "_upto - _c AS _before")

    outside = "raise_error('a quantile lies outside its bracket')"
    within = f"PARTITION BY {', '.join([*keys, '_place', '_cell'])}"
    same = " AND ".join(f"f.{k} <=> c.{k}" for k in [*keys, "_place", "_cell"])
    fine = counted.alias("f").join(cells.alias("c"), F.expr(same)).selectExpr(
        *[f"f.{k} AS {k}" for k in keys], "f._place", "f._cell", "_n", "_before", "_c", f"if(_gap, {outside}, _m) AS _m"
    )
    fine = fine.selectExpr("*", f"_before + sum(_c) OVER ({within} ORDER BY _m ROWS UNBOUNDED PRECEDING) AS _upto")
    picks = [F.expr(f"{_pick(p, method)} AS {name}") for name, p in quantiles.items()]
    return fine.groupBy(*keys).agg(*picks)


#: Order-preserving number of a value's cell; 1100 lifts the smallest exponent above zero. NaN comes last, as in a sort.
CELL = (
    f"CASE WHEN isnan(_v) THEN {4000 * FINE} WHEN _v = 0 THEN 0 "
    f"ELSE CAST(signum(_v) * floor((least(log2(abs(_v)), 2000D) + 1100) * {FINE}) AS int) END"
)


def _with_brackets(rows: DataFrame, keys: list[str], probabilities: list[float], method: str) -> DataFrame:
    """The rows with _lo and _hi of each quantile: the ends of the cells that hold its ranks."""
    group = f"PARTITION BY {', '.join(keys)} " if keys else ""
    cells = rows.groupBy(*keys, F.expr(f"{CELL} AS _cell")).agg(
        F.expr("count(*) AS _c"), F.expr("min(_v) AS _min"), F.expr("max(_v) AS _max")
    )
    cells = cells.selectExpr(
        "*", f"sum(_c) OVER ({group}) AS _n", f"sum(_c) OVER ({group}ORDER BY _cell ROWS UNBOUNDED PRECEDING) AS _upto"
    )
    ends = []
    for i, p in enumerate(probabilities):
        ranks = _ranks(p, method)
        inside = [f"{rank} > _upto - _c AND {rank} <= _upto" for rank in (ranks[0], ranks[-1])]
        ends.append(F.expr(f"min(if({inside[0]}, _min, NULL)) AS _lo{i}"))
        ends.append(F.expr(f"max(if({inside[1]}, _max, NULL)) AS _hi{i}"))
    # Staged, so that the size of the table decides whether it is broadcast to the rows.
    bounds = stage(cells.groupBy(*keys).agg(*ends), "quantile-bounds")
    if not keys:
        return rows.withColumn("_b", bounds.select(F.struct("*")).scalar()).select("_v", "_b.*")
    side = bounds.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return rows.join(side, F.expr(" AND ".join(f"{k} <=> _k_{k}" for k in keys)))


def _ranks(p: float, method: str) -> tuple[str, ...]:
    if method == "disc":
        return (f"greatest(1, ceil(_n * {p}D))",)
    return f"floor((_n - 1) * {p}D) + 1", f"ceil((_n - 1) * {p}D) + 1"


def _pick(p: float, method: str) -> str:
    at = [f"min(if(_upto >= {rank}, _m, NULL))" for rank in _ranks(p, method)]
    if method == "disc":
        return at[0]
    share = f"max((_n - 1) * {p}D - floor((_n - 1) * {p}D))"
    return f"{at[0]} + ({at[1]} - {at[0]}) * {share}"


def exact_median(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """The discrete median: always one of the group's own values."""
    return exact_quantiles(df, keys, value, {name: 0.5})


BOX = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0}


def five_numbers(df: DataFrame, keys: Sequence[str], value: str, detail: bool = False) -> DataFrame:
    """Box-plot rows: quartiles, Tukey fences, whisker ends and the number of outliers.

    Set ``detail`` for rows finer than the cube's.
    """
    keys = list(keys)
    if detail:
        box = stage(exact_quantiles(df, keys, F.col(value), BOX, "cont"), "box")
    else:
        box = grouped_quantiles(df, keys, value, BOX, "cont")
    box = box.withColumns(
        {
            "lower_fence": F.expr("q1 - 1.5D * (q3 - q1)"),
            "upper_fence": F.expr("q3 + 1.5D * (q3 - q1)"),
        }
    )
    v = F.col(value)
    inside = v.between(F.col("lower_fence"), F.col("upper_fence"))
    return (
        df.where(v.isNotNull()).select(*keys, value).join(box, keys)
        .groupBy(*keys, "q0", "q1", "q2", "q3", "q4", "lower_fence", "upper_fence")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(~inside).alias("n_outliers"),
            F.min(F.when(inside, v)).alias("lower_whisker"),
            F.max(F.when(inside, v)).alias("upper_whisker"),
        )
    )
